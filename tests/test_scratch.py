"""No scratch table outlives the job that made it, and papers move between years."""

import datetime as dt
import os

import pytest
from paperloom import cut_lineage
from paperloom.plans import backlog_and_split, harvest_feed, harvest_window, harvest_years, merge_increment, upsert_years
from paperloom.schema import ModelSpec
from paperloom.session import _shared_root, scratch_scope
from paperloom.sources.tables import read_vectors, read_years
from paperloom.streaming import stream_table, upsert_stream
from paperloom.versions import bucket_of, create_table, live_parts, snapshot
from pyspark.sql import functions as F
from test_sources import feeds, pages  # noqa: F401

DAY = "2024-01-01T00:00:00Z"
BATCH = "id string, created string, updated string, title string"


def _scratch(spark):
    root = f"{_shared_root(spark)}/paperloom"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def _batch(spark, *rows):
    return spark.createDataFrame([(i, c, None, t) for i, c, t in rows], BATCH)


def test_scopes_nest_and_drop_after_failures(spark):
    before = _scratch(spark)
    with pytest.raises(RuntimeError), scratch_scope():
        outer = cut_lineage(spark.range(5), "outer")
        with scratch_scope():
            cut_lineage(outer, "inner")
        assert outer.count() == 5 and len(_scratch(spark) - before) == 1
        raise RuntimeError("the job fails")
    assert _scratch(spark) == before
    kept = cut_lineage(spark.range(3), "kept")
    assert len(_scratch(spark) - before) == 1 and kept.count() == 3


@pytest.mark.parametrize("versioned", [False, True])
def test_jobs_leave_nothing(spark, folder, pages, feeds, versioned):  # noqa: F811
    before, root = _scratch(spark), folder("table")
    if versioned:
        create_table(spark, root, spark.createDataFrame([], "id string, year int").schema, 4)
    harvest_years(spark, pages, root, [2024, 2025], dt.date(2025, 6, 1))
    harvest_years(spark, pages, root, [2024, 2025], dt.date(2025, 6, 1), mode="merge")
    harvest_window(spark, pages, folder("window"), until=dt.date(2024, 1, 3))
    harvest_feed(spark, feeds, folder("feed"))
    merge_increment(spark, _batch(spark, ("a", DAY, "x"), ("n", DAY, "y")), root, 2024)
    upsert_years(spark, _batch(spark, ("a", DAY, "z"), ("bad", "?", "y")), root)
    models = {"m1": ModelSpec("m1", "one", 8)}
    summary = backlog_and_split(read_years(spark, root), read_vectors(spark, folder("none")), models, folder("lists"))
    assert summary.count() == 1 and _scratch(spark) == before
    with pytest.raises(Exception, match="title|CAST_INVALID_INPUT|versioned table only"):
        upsert_years(spark, _batch(spark, ("a", DAY, "z")).withColumn("title", F.lit(1)), root, move=not versioned)
    assert _scratch(spark) == before


def test_ten_micro_batches_leave_nothing(spark, folder):
    landed, root = folder("landed"), folder("table")
    for k in range(10):
        _batch(spark, (f"a{k % 3}", DAY, f"t{k}")).coalesce(1).write.mode("append").parquet(landed)
    before = _scratch(spark)
    stream = stream_table(spark, landed, spark.createDataFrame([], BATCH).schema, max_files=1)
    upsert_stream(stream, root, folder("state")).awaitTermination()
    assert _scratch(spark) == before and read_years(spark, root).count() == 3


def test_a_paper_whose_year_is_corrected_moves(spark, folder):
    root = folder("table")
    create_table(spark, root, spark.createDataFrame([], "id string, year int").schema, 4)
    rows = [(f"p{k}", f"{2020 + k % 3}-01-01T00:00:00Z", "old") for k in range(30)] + [("lone", "1999-01-01T00:00:00Z", "old")]
    upsert_years(spark, _batch(spark, *rows), root)
    before = live_parts(spark, root, snapshot(spark, root))
    moved = _batch(spark, ("p0", "2022-05-05T00:00:00Z", "new"), ("lone", "2020-05-05T00:00:00Z", "new"), ("fresh", DAY, "new"))
    result = upsert_years(spark, moved, root, move=True)
    got = {(r.id, r.year, r.title) for r in read_years(spark, root).filter("id in ('p0', 'lone', 'fresh')").collect()}
    assert got == {("p0", 2022, "new"), ("lone", 2020, "new"), ("fresh", 2024, "new")}
    assert read_years(spark, root).count() == 32 and result.years == [1999, 2020, 2022, 2024]
    after = live_parts(spark, root, snapshot(spark, root))
    buckets = {r[0] for r in moved.select(bucket_of("id", 4)).collect()}
    assert {b for (y, b), v in after.items() if before.get((y, b)) != v} <= buckets
    # Without it a paper lives in each year it was given.
    upsert_years(spark, _batch(spark, ("p1", "2000-05-05T00:00:00Z", "new")), root)
    assert read_years(spark, root).filter("id = 'p1'").count() == 2
