"""Versioned tables: one commit switches years, buckets bound what a batch rewrites."""

import datetime as dt
import os

import pytest
from paperloom import versions
from paperloom.plans import harvest_years, merge_artifacts, merge_increment, upsert_years
from paperloom.sinks.tables import replace_years, write_years
from paperloom.sources.tables import read_years
from paperloom.versions import ConcurrentChange, bucket_of, create_table, drop_versions, live_parts, read_table, replace_parts, snapshot
from pyspark.sql import functions as F
from test_sources import _page, _record

SCHEMA = "id string, title string, year int"
DAY = "2024-01-01T00:00:00Z"


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def _papers(spark, n, year, title="old"):
    return spark.range(n).select(F.concat(F.lit("p"), "id").alias("id"), F.lit(title).alias("title"), F.lit(year).alias("year"))


def _files(root):
    return {
        os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns
        for folder, _, names in os.walk(f"{root}/data") for n in names if n.endswith(".parquet")
    }


@pytest.fixture
def root(spark, folder):
    path = folder("versioned")
    create_table(spark, path, spark.createDataFrame([], SCHEMA).schema, buckets=4)
    return path


def test_years_are_replaced_and_older_commits_stay_readable(spark, root):
    assert read_years(spark, root).count() == 0 and read_years(spark, root).columns == ["id", "title", "year"]
    assert replace_years(_papers(spark, 20, 2023).unionByName(_papers(spark, 20, 2024)), root) == 40
    written = _files(root)
    changed = read_years(spark, root, [2024]).withColumn("title", F.lit("new")).filter("id <> 'p0'")
    assert replace_years(changed, root) == 19
    assert _rows(read_years(spark, root).groupBy("year", "title").count(), "year", "title", "count") == [(2023, "old", 20), (2024, "new", 19)]
    # Every row was written once: nothing of the first write changed, and the second wrote 2024 only.
    after = _files(root)
    assert {k: after[k] for k in written} == written
    assert spark.read.parquet(*[f for f in after if f not in written]).count() == 19
    assert read_table(spark, root, number=1).filter("title = 'old'").count() == 40
    with pytest.raises(ValueError, match="already"):
        create_table(spark, root, spark.createDataFrame([], SCHEMA).schema)
    assert replace_years(_papers(spark, 0, 2024), root) == 0


def test_a_job_killed_before_the_swap_changes_nothing(spark, root, monkeypatch):
    replace_years(_papers(spark, 20, 2024), root)
    before = snapshot(spark, root)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            replace_years(_papers(spark, 5, 2024, "new"), root)
    assert snapshot(spark, root) == before and read_years(spark, root).filter("title = 'old'").count() == 20
    assert replace_years(_papers(spark, 5, 2024, "new"), root) == 5
    assert read_years(spark, root).count() == 5
    # What the killed job left is removed with the older commits.
    assert drop_versions(spark, root, keep=1) > 0
    assert read_years(spark, root).count() == 5 and spark.read.parquet(*_files(root)).count() == 5


def test_writers_of_other_parts_both_succeed(spark, root):
    replace_years(_papers(spark, 40, 2024), root)
    start = snapshot(spark, root)
    mine = read_table(spark, root, {2024: frozenset({0, 1})}, start.number).withColumn("title", F.lit("mine"))
    theirs = read_table(spark, root, {2024: frozenset({2})}, start.number).withColumn("title", F.lit("theirs"))
    replace_parts(theirs, root, {2024: frozenset({2})}, start)
    replace_years(_papers(spark, 3, 2025), root)
    replace_parts(mine, root, {2024: frozenset({0, 1})}, start)
    got = {(r.bucket, r.title) for r in read_years(spark, root, [2024]).select(bucket_of("id", 4).alias("bucket"), "title").collect()}
    assert got == {(0, "mine"), (1, "mine"), (2, "theirs"), (3, "old")}
    assert read_years(spark, root).count() == 43
    late = read_table(spark, root, {2024: frozenset({2})}, start.number)
    with pytest.raises(ConcurrentChange):
        replace_parts(late, root, {2024: frozenset({2})}, start)
    with pytest.raises(ValueError, match="not to be replaced"):
        replace_parts(_papers(spark, 40, 2024), root, {2024: frozenset({2})})
    assert {r.title for r in read_years(spark, root, [2024]).collect()} == {"mine", "theirs", "old"}


def test_a_lost_race_for_the_commit_is_run_again(spark, root, monkeypatch):
    """Another writer takes the commit number between reading the newest commit and the rename."""
    replace_years(_papers(spark, 8, 2023), root)
    real, raced = versions._commit, []

    def racing(spark_, root_, new):
        if not raced:
            raced.append(True)
            replace_years(_papers(spark, 4, 2022), root)
        return real(spark_, root_, new)

    monkeypatch.setattr(versions, "_commit", racing)
    assert replace_years(_papers(spark, 6, 2024), root) == 6
    assert _rows(read_years(spark, root).groupBy("year").count(), "year", "count") == [(2022, 4), (2023, 8), (2024, 6)]


def test_a_batch_rewrites_only_its_buckets(spark, root):
    replace_years(_papers(spark, 200, 2023).unionByName(_papers(spark, 200, 2024)), root)
    before = live_parts(spark, root, snapshot(spark, root))
    batch = spark.createDataFrame([("p7", DAY, "new"), ("p7x", DAY, "added")], "id string, created string, title string")
    hit = {r[0] for r in batch.select(bucket_of("id", 4)).collect()}
    result = upsert_years(spark, batch, root)
    after = live_parts(spark, root, snapshot(spark, root))
    assert {p for p in after if after[p] != before[p]} == {(2024, b) for b in hit}
    assert result.years == [2024] and result.rows_written == read_years(spark, root, [2024]).filter(bucket_of("id", 4).isin(list(hit))).count()
    table = {(r.id, r.year): r for r in read_years(spark, root).collect()}
    assert len(table) == 401 and table["p7", 2024].title == "new" and table["p7", 2023].title == "old" and table["p7x", 2024].title == "added"
    merged = merge_increment(spark, batch.withColumn("updated", F.lit("2024-02-01")).filter("id = 'p7'").withColumn("title", F.lit("later")), root, 2024)
    assert (merged.inserted, merged.updated, merged.unchanged) == (0, 1, 200)
    third = live_parts(spark, root, snapshot(spark, root))
    assert len({p for p in third if third[p] != after[p]}) == 1
    vectors = spark.createDataFrame([("p3", 2023, "m1", [1.0], 0)], "id string, year int, model_key string, vector array<float>, seq long")
    merge_artifacts(spark, root, vectors, ["m1"])
    fourth = live_parts(spark, root, snapshot(spark, root))
    assert [p[0] for p in fourth if fourth[p] != third[p]] == [2023]
    assert _rows(read_years(spark, root).filter("m1 is not null"), "id", "year", "m1") == [("p3", 2023, [1.0])]


def test_the_schema_is_stored_and_grows(spark, root):
    replace_years(_papers(spark, 3, 2023).withColumn("m1", F.array(F.lit(1.0).cast("float"))), root)
    replace_years(_papers(spark, 3, 2024).withColumn("m2", F.array(F.lit(2.0).cast("float"))), root)
    spark.sparkContext.setJobGroup("opened", "no job reads footers to learn the schema")
    table = read_years(spark, root)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("opened")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert table.columns == ["id", "title", "year", "m1", "m2"]
    assert _rows(table.groupBy("year").agg(F.count("m1").alias("a"), F.count("m2").alias("b")), "year", "a", "b") == [(2023, 3, 0), (2024, 0, 3)]
    assert read_years(spark, root, [2024], model_keys=["m2"]).columns[-2:] == ["m2", "year"]
    with pytest.raises(ValueError, match="column title is"):
        replace_years(_papers(spark, 3, 2025).withColumn("title", F.lit(1)), root)


def test_drop_versions_keeps_what_the_newest_commits_name(spark, root):
    for k in range(4):
        batch = spark.createDataFrame([(f"p{k}", DAY, f"t{k}")], "id string, created string, title string")
        upsert_years(spark, batch, root)
    commits = versions.commits(spark, root)
    assert drop_versions(spark, root, keep=2) >= 0
    assert versions.commits(spark, root) == commits[-2:]
    assert read_years(spark, root).count() == 4 and read_table(spark, root, number=commits[-2]).count() == 3
    with pytest.raises(ValueError):
        drop_versions(spark, root, keep=0)


@pytest.mark.parametrize("versioned", [False, True])
def test_redelivery_keeps_vectors(spark, folder, versioned):
    root, pages = folder("table"), folder("pages")
    _page(pages, "1.xml", *[_record(f"a{k}", title=f"t{k}") for k in range(30)])
    if versioned:
        create_table(spark, root, spark.createDataFrame([], SCHEMA).schema, buckets=4)
    assert harvest_years(spark, pages, root, [2024], dt.date(2024, 6, 1)) == 30
    wide = read_years(spark, root).withColumn("m1", F.array(F.lit(1.0).cast("float")))
    replace_years(wide, root) if versioned else replace_years(wide, root, staged=True)
    assert harvest_years(spark, pages, root, [2024], dt.date(2024, 6, 1), mode="merge") == 0
    assert read_years(spark, root).filter("m1 is not null").count() == 30
    upsert_years(spark, read_years(spark, root).drop("m1", "year"), root, rule=2024)
    assert read_years(spark, root).filter("m1 is not null").count() == 30
    changed = read_years(spark, root).drop("m1", "year").withColumn("title", F.when(F.col("id") == "a1", "other").otherwise(F.col("title")))
    upsert_years(spark, changed, root, rule=2024)
    assert _rows(read_years(spark, root).filter("m1 is null"), "id", "title") == [("a1", "other")]
    _page(pages, "2.xml", _record("a2", updated="<updated>2024-01-05</updated>", title="later"))
    assert harvest_years(spark, pages, root, [2024], dt.date(2024, 6, 1), mode="merge") >= 1
    # a1 is harvested as it was at first, which differs from what is stored at an equal date.
    assert _rows(read_years(spark, root).filter("m1 is null"), "id", "title") == [("a1", "t1"), ("a2", "later")]
