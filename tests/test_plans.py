"""Physical plans have the shape that holds at scale."""

import datetime as dt
import re

from paperloom.functions.dates import within
from paperloom.operators.backlog import backlog, backlog_wide
from paperloom.operators.dedup import latest
from paperloom.operators.embed import embed, hash_encoder
from paperloom.operators.overlay import overlay
from paperloom.operators.split import split_tasks
from paperloom.operators.status import tasks_of_papers
from paperloom.operators.upsert import merge_latest
from paperloom.operators.years import select_years
from paperloom.schema import ModelSpec
from paperloom.sinks.tables import write_artifacts, write_years
from pyspark.sql import functions as F

MODELS = {"m1": ModelSpec("m1", "one", 8), "m2": ModelSpec("m2", "two", 8)}


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[-1]


def lines(df, word):
    return [line for line in plan(df).split("\n") if word in line]


def _stored(spark, folder, n=1000):
    papers = spark.range(n).select(
        F.col("id").cast("string").alias("id"), (F.lit(2020) + F.col("id") % 4).cast("int").alias("year"),
        F.lit("t").alias("title"), F.lit("2024-01-01").alias("updated"),
    )
    root, vectors_root = folder("papers"), folder("vectors")
    write_years(papers, root)
    vectors = papers.select("id", "year", F.lit("m1").alias("model_key"), F.array_repeat(F.lit(1.0).cast("float"), 8).alias("vector"))
    write_artifacts(vectors.withColumns({"vector_sum": F.lit(8.0), "seq": F.lit(1).cast("bigint")}), vectors_root)
    return spark.read.parquet(root), spark.read.parquet(vectors_root)


def test_dedup_limits_groups_before_the_shuffle(spark, folder):
    papers, _ = _stored(spark, folder)
    text = plan(latest(papers, tie=("title",)))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_unused_columns_stay_out_of_the_scan(spark, folder):
    papers, _ = _stored(spark, folder)
    scan = lines(latest(papers, tie=("year",)).select("id", "updated"), "FileScan")[0]
    assert "title" not in re.search(r"ReadSchema: (.*)", scan).group(1)


def test_small_merge_does_not_shuffle_the_table(spark, folder):
    papers, _ = _stored(spark, folder)
    new = papers.limit(5).withColumn("title", F.lit("new"))
    merged = merge_latest(papers, new, ("id", "year"), tie=("title",))
    untouched = plan(merged).split("LeftAnti")[1].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan(merged) and "Exchange" not in untouched


def test_backlog_never_reads_vectors_and_shuffles_papers_once(spark, folder):
    papers, vectors = _stored(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = backlog(papers, vectors, MODELS)
        scans = lines(tasks, "FileScan")
        assert not any("vector:" in re.search(r"ReadSchema: (.*)", s).group(1) for s in scans)
        assert plan(tasks).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_backlog_is_one_scan_without_a_shuffle(spark, folder):
    papers, _ = _stored(spark, folder)
    assert "Exchange" not in plan(backlog_wide(papers, MODELS))


def test_split_ranks_tasks_per_bucket(spark, folder):
    papers, _ = _stored(spark, folder)
    tasks = papers.select("id", "year", F.lit("m1").alias("model_key"))
    text = plan(split_tasks(tasks, unique=True))
    single = text.split("Exchange SinglePartition")
    assert len(single) == 2
    # Below the only single-partition exchange lie bucket counts, not tasks.
    assert single[1].lstrip().split("\n")[1].strip().startswith("+- HashAggregate(keys=[__bucket")
    assert text.count("Exchange hashpartitioning") == 2


def test_split_of_a_table_with_copies_reuses_its_ranking(spark, folder):
    papers, _ = _stored(spark, folder)
    df = split_tasks(papers.select("id", "year", F.lit("m1").alias("model_key")))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_overlay_shuffles_each_vector_once(spark, folder):
    papers, vectors = _stored(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(overlay(papers, vectors, ["m1", "m2"])).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_papers_are_cut_to_their_tasks_before_python(spark, folder):
    papers, vectors = _stored(spark, folder)
    wanted = tasks_of_papers(papers.withColumn("text", F.col("title")), vectors)
    text = plan(embed(wanted, hash_encoder(8), 8, partitions=4))
    assert text.index("MapInArrow") < text.index("RoundRobinPartitioning(4)") < text.index("LeftSemi")


def test_filters_reach_the_scan(spark, folder):
    papers, _ = _stored(spark, folder)
    day = lines(papers.filter(within("updated", (dt.date(2024, 1, 1), dt.date(2024, 1, 2)))), "FileScan")[0]
    assert "GreaterThanOrEqual(updated,2024-01-01)" in day and "LessThan(updated,2024-01-03)" in day
    for years, exact in (("2021", True), ("2021", False)):
        scan = lines(select_years(papers, years, exact), "FileScan")[0]
        assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
