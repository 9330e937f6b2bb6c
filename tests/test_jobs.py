"""Whole jobs on stored tables."""

import datetime as dt
import os

import pytest
from paperloom import cut_lineage, shared_dir
from paperloom.operators.backlog import backlog
from paperloom.operators.embed import embed, embed_table, hash_encoder
from paperloom.plans import (
    backlog_and_split,
    embed_whole,
    harvest_feed,
    harvest_window,
    harvest_years,
    merge_artifacts,
    merge_increment,
    run_tasks,
    upsert_years,
)
from paperloom.schema import PAPER_COLUMNS, ModelSpec
from paperloom.sinks.tables import replace_years, write_artifacts, write_status, write_years
from paperloom.sources.tables import read_tasks, read_vectors, read_years
from pyspark.sql import functions as F
from test_sources import _page, _record, _token, feeds, pages  # noqa: F401

MODELS = {"m1": ModelSpec("m1", "one", 8), "m2": ModelSpec("m2", "two", 4)}
ENCODERS = {"m1": hash_encoder(8), "m2": hash_encoder(4)}
TODAY = dt.date(2024, 6, 1)


def _papers(spark, n=40, year=2024):
    return spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("id"), F.lit(year).alias("year"),
        F.concat(F.lit("title "), "id").alias("title"), F.lit("text").alias("abstract"),
    )


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_year_harvest_replace_and_merge(spark, pages, folder):  # noqa: F811
    root = folder("table")
    old = spark.createDataFrame([("a", "2023-12-31"), ("z", "2020-01-01")], "id string, updated string")
    old = old.selectExpr("id", "updated", *[f"cast(null as string) as {c}" for c in PAPER_COLUMNS if c not in ("id", "updated", "authors", "categories")])
    old = old.withColumns({c: F.array().cast("array<string>") for c in ("authors", "categories")}).withColumn("year", F.lit(2024))
    write_years(old.select(*PAPER_COLUMNS, "year"), root)
    assert harvest_years(spark, pages, root, [2024], TODAY, mode="merge") == 3
    assert _rows(read_years(spark, root), "id", "updated") == [("a", "2024-01-02"), ("b", None), ("z", "2020-01-01")]
    assert harvest_years(spark, pages, root, [2024], TODAY) == 2
    assert _rows(read_years(spark, root), "id") == [("a",), ("b",)]
    assert harvest_years(spark, pages, root, [2024, 2025], dt.date(2025, 6, 1)) == 3
    assert _rows(read_years(spark, root), "id", "year") == [("a", 2024), ("b", 2024), ("c", 2025)]
    assert harvest_years(spark, pages, root, [2019], TODAY) == 0
    assert read_years(spark, root).count() == 3


def test_incomplete_harvest_leaves_the_year_alone(spark, folder):
    path, root = folder("short"), folder("table")
    write_years(_papers(spark), root)
    _page(path, "1.xml", _record("a"), trailer=_token("", 9))
    with pytest.raises(RuntimeError, match="incomplete"):
        harvest_years(spark, path, root, [2024], TODAY)
    assert read_years(spark, root).count() == 40


def test_window_harvest_writes_an_empty_table(spark, pages, folder):  # noqa: F811
    output = folder("window")
    assert harvest_window(spark, pages, output, until=dt.date(2024, 1, 3)) == 2
    assert harvest_window(spark, pages, output, until=dt.date(2001, 1, 3)) == 0
    empty = spark.read.parquet(output)
    assert empty.columns == PAPER_COLUMNS and empty.count() == 0


def test_feed_harvest_skips_an_empty_result(spark, feeds, folder):  # noqa: F811
    output, nothing = folder("feed"), folder("none")
    assert harvest_feed(spark, feeds, output) == 2
    os.makedirs(nothing)
    with open(os.path.join(nothing, "x.xml"), "w") as out:
        out.write("<rss><channel></channel></rss>")
    assert harvest_feed(spark, nothing, output) == 0
    assert spark.read.parquet(output).count() == 2


def test_year_table_is_sorted_and_typed_when_empty(spark, folder):
    root = folder("years")
    assert write_years(_papers(spark, 500), root) == 500
    for name in os.listdir(f"{root}/year=2024"):
        if name.endswith(".parquet"):
            ids = [r.id for r in spark.read.parquet(f"{root}/year=2024/{name}").collect()]
            assert ids == sorted(ids)
    empty = folder("empty")
    assert write_years(_papers(spark, 0), empty) == 0
    assert sorted(spark.read.parquet(empty).columns) == ["abstract", "id", "title", "year"]
    assert write_years(_papers(spark, 0), root, on_empty="skip") == 0
    assert read_years(spark, root).count() == 500


@pytest.mark.parametrize("staged", [True, False])
def test_replace_touches_only_its_years(spark, folder, staged):
    root = folder("years")
    write_years(_papers(spark, 10, 2023).unionByName(_papers(spark, 10, 2024)), root)
    before = {n: os.path.getmtime(f"{root}/year=2023/{n}") for n in os.listdir(f"{root}/year=2023")}
    changed = read_years(spark, root, [2024]).withColumn("title", F.lit("new")).filter("id <> 'p0'")
    assert replace_years(changed, root, staged=staged) == 9
    assert {n: os.path.getmtime(f"{root}/year=2023/{n}") for n in os.listdir(f"{root}/year=2023")} == before
    assert _rows(read_years(spark, root).groupBy("year", "title").count().filter("title = 'new'"), "year", "count") == [(2024, 9)]


def test_upsert_twice_equals_once_and_keeps_vectors(spark, folder):
    root, quarantine = folder("table"), folder("bad")
    stored = _papers(spark, 10).withColumn("m1", F.array(F.lit(1.0).cast("float")))
    write_years(stored, root)
    rows = [("p1", "2024-01-01T00:00:00Z", "x", 1), ("p1", "2024-01-01T00:00:00Z", "y", 2),
            ("new", "2023-01-01T00:00:00Z", "z", 3), ("bad", "2023-01-01", "b", 4)]
    batch = spark.createDataFrame(rows, "id string, created string, title string, n int")
    first = upsert_years(spark, batch, root, quarantine, arrival=("n",))
    assert (first.years, first.rows_written, first.rows_invalid) == ([2023, 2024], 11, 1)
    once = _rows(read_years(spark, root), "id", "year", "title", "m1")
    upsert_years(spark, batch, root, arrival=("n",))
    assert _rows(read_years(spark, root), "id", "year", "title", "m1") == once
    table = {r.id: r for r in read_years(spark, root).collect()}
    assert table["p1"].title == "y" and table["new"].year == 2023 and table["p2"].m1 == [1.0]
    assert table["p1"].m1 is None and "n" not in read_years(spark, root).columns
    assert [r.id for r in spark.read.parquet(quarantine).collect()] == ["bad"]
    none = upsert_years(spark, batch.filter("id = 'bad'"), root)
    assert (none.years, none.rows_written, none.rows_invalid) == ([], 0, 1)


def test_upsert_zero_fills_missing_model_columns(spark, folder):
    root = folder("table")
    stored = _papers(spark, 2).withColumn("m1", F.array_repeat(F.lit(1.0).cast("float"), 8))
    write_years(stored, root)
    batch = spark.createDataFrame([("p0", "2024-01-01T00:00:00Z")], "id string, created string")
    upsert_years(spark, batch, root, models=MODELS, fill="zero")
    table = {r.id: r for r in read_years(spark, root).collect()}
    assert table["p0"].m1 == [0.0] * 8 and table["p1"].m1 == [1.0] * 8 and table["p1"].m2 == [0.0] * 4


def test_increment_merge_counts_and_forgets_vectors(spark, folder):
    root, vectors_root = folder("table"), folder("vectors")
    first = spark.createDataFrame([("a", "2024-01-01", "t"), ("b", None, "t"), ("c", "2024-01-05", "t")], "id string, updated string, title string")
    loaded = merge_increment(spark, first, root, 2024)
    assert (loaded.inserted, loaded.updated, loaded.net_growth, loaded.rows_written) == (3, 0, 3, 3)
    done = run_tasks(read_years(spark, root).withColumn("abstract", F.lit("x")), _all_tasks(read_years(spark, root)), MODELS, ENCODERS, seq=1, output=vectors_root)
    assert done.vectors.count() == 6
    second = spark.createDataFrame([("a", "2024-02-01", "u"), ("b", "2020-01-01", "u"), ("c", "2024-01-01", "u"), ("d", None, "u")], "id string, updated string, title string")
    merged = merge_increment(spark, second, root, 2024, vectors_root=vectors_root, models=MODELS, seq=2)
    assert (merged.inserted, merged.updated, merged.unchanged, merged.net_growth, merged.rows_written) == (1, 2, 1, 1, 4)
    assert _rows(read_years(spark, root), "id", "title") == [("a", "u"), ("b", "u"), ("c", "t"), ("d", "u")]
    missing = backlog(read_years(spark, root), spark.read.parquet(vectors_root), {"m1": MODELS["m1"]})
    assert _rows(missing, "id") == [("a",), ("b",), ("d",)]
    again = merge_increment(spark, second, root, 2024, vectors_root=vectors_root, models=MODELS, seq=3)
    assert (again.inserted, again.updated, again.rows_written) == (0, 0, 0)
    literal = merge_increment(spark, second.filter("id = 'd'").withColumn("title", F.lit("v")), root, 2024, nulls="first")
    assert literal.inserted == 0


def test_redelivery_keeps_wide_vectors_and_a_correction_wins(spark, folder):
    root = folder("table")
    rows = [("a", "2024-01-01", "t"), ("b", None, "t"), ("c", "2024-01-05", "t")]
    first = spark.createDataFrame(rows, "id string, updated string, title string")
    write_years(first.withColumns({"m1": F.array(F.lit(1.0).cast("float")), "year": F.lit(2024)}), root)
    again = merge_increment(spark, first, root, 2024)
    assert (again.inserted, again.updated, again.unchanged, again.rows_written) == (0, 0, 3, 0)
    fixed = spark.createDataFrame([("a", "2024-01-01", "s"), ("b", None, "s"), ("c", None, "s")], first.schema)
    assert merge_increment(spark, fixed, root, 2024).updated == 2
    assert _rows(read_years(spark, root), "id", "title", "m1") == [("a", "s", None), ("b", "s", None), ("c", "t", [1.0])]


def test_forgotten_vectors_stay_forgotten(spark, folder):
    root, vectors_root = folder("table"), folder("vectors")
    write_years(_papers(spark, 4), root)
    table = read_years(spark, root)
    run_tasks(table, _all_tasks(table), MODELS, ENCODERS, output=vectors_root)
    merge_artifacts(spark, root, read_vectors(spark, vectors_root), list(MODELS))
    batch = spark.createDataFrame([("p1", "2024-01-01T00:00:00Z", "new"), ("p2", "2024-01-01T00:00:00Z", "title 2")], "id string, created string, title string")
    # The same seq as the vectors: the forgotten rows win the tie.
    upsert_years(spark, batch, root, models=MODELS, vectors_root=vectors_root, seq=0)
    vectors = read_vectors(spark, vectors_root)
    assert _rows(backlog(read_years(spark, root), vectors, MODELS), "id", "model_key") == [("p1", "m1"), ("p1", "m2")]
    merge_artifacts(spark, root, vectors, list(MODELS))
    assert _rows(read_years(spark, root).filter("m1 is null"), "id") == [("p1",)]
    again = run_tasks(read_years(spark, root), backlog(read_years(spark, root), vectors, MODELS), MODELS, ENCODERS, output=vectors_root)
    assert again.vectors.count() == 2 and backlog(read_years(spark, root), read_vectors(spark, vectors_root), MODELS).isEmpty()


def test_malformed_pages_stop_a_window_and_a_merge(spark, folder):
    path, root = folder("broken"), folder("table")
    _page(path, "1.xml", _record("a"), "<record><header></metadata></record>", _record("c"))
    with pytest.raises(RuntimeError, match="incomplete"):
        harvest_window(spark, path, folder("window"), until=dt.date(2024, 1, 3))
    with pytest.raises(RuntimeError, match="incomplete"):
        harvest_years(spark, path, root, [2024], TODAY, mode="merge")
    assert harvest_window(spark, path, folder("window"), until=dt.date(2024, 1, 3), check_complete=False) >= 1


def _all_tasks(papers):
    keys = F.array(*[F.lit(k) for k in MODELS])
    return papers.select("id", "year", F.explode(keys).alias("model_key"))


def test_backlog_split_run_and_merge_empty_the_backlog(spark, folder):
    root, lists, vectors_root = folder("table"), folder("lists"), folder("vectors")
    papers = _papers(spark, 60, 2023).unionByName(_papers(spark, 40, 2024))
    write_years(papers, root)
    table = read_years(spark, root)
    summary = backlog_and_split(table, read_vectors(spark, vectors_root), MODELS, lists, lists=7)
    assert summary.first()[:4] == (200, 200, 0, 7)
    assert read_tasks(spark, lists).count() == 200
    for k in range(7):
        tasks = read_tasks(spark, lists, matrix_id=k)
        assert tasks.count() == (29 if k < 6 else 26)
        run = run_tasks(table, tasks, MODELS, ENCODERS, seq=k, output=vectors_root, partitions=2)
        assert _rows(run.status.groupBy("status").count(), "status", "count") == [("processed", tasks.count())]
    vectors = read_vectors(spark, vectors_root)
    assert backlog(table, vectors, MODELS).count() == 0
    assert merge_artifacts(spark, root, vectors, ["m1", "m2"]) == 100
    wide = read_years(spark, root)
    assert wide.filter("size(m1) = 8 and size(m2) = 4").count() == 100


def _broken():
    def factory():
        raise RuntimeError("no such model")

    return factory


def test_task_failures_are_reported(spark, folder):
    papers = _papers(spark, 3)
    tasks = spark.createDataFrame(
        [("p0", 2024, "m1"), ("p1", 2024, "m2"), ("nope", 2024, "m1"), ("p2", 1999, "m1"), ("p2", 2024, "m3")],
        "id string, year int, model_key string",
    )
    run = run_tasks(papers, tasks, MODELS, {"m1": hash_encoder(8), "m2": _broken()}, output=folder("v"))
    status = {(r.id, r.year, r.model_key): (r.status, r.error) for r in run.status.collect()}
    assert status["p0", 2024, "m1"] == ("processed", None)
    assert status["p1", 2024, "m2"] == ("failed", "encoder could not be started: no such model")
    assert status["nope", 2024, "m1"] == status["p2", 1999, "m1"] == ("failed", "id is not in the table for this year")
    assert status["p2", 2024, "m3"] == ("failed", "no configuration for model m3")
    assert run.vectors.count() == 1
    root = folder("status")
    write_status(run.status, root)
    assert spark.read.json(f"{root}/summary").first().failed == 4
    assert spark.read.json(f"{root}/top_reasons").count() == 3
    assert spark.read.json(f"{root}/first_failures").count() == 4


def _moody():
    """Fails on one text, gives the first of a batch a short vector, and forgets the last."""

    def factory():
        def encode(texts):
            if any("title 7" in t for t in texts):
                raise ValueError("bad batch")
            return [[1.0]] + [[1.0, 2.0] for _ in texts[1:-1]]

        return encode

    return factory


def test_encoder_problems_become_nan_vectors(spark, folder):
    texts = _papers(spark, 8).select("id", "year", F.col("title").alias("text")).coalesce(1)
    rows = {r.id: r for r in embed(texts, _moody(), 2, batch_size=4).collect()}
    assert rows["p0"].error == "vector length 1 is not 2" and rows["p3"].error == "vector length 0 is not 2"
    assert rows["p1"].vector == [1.0, 2.0] and rows["p1"].error is None and rows["p1"].vector_sum == 3.0
    assert {rows[f"p{k}"].error for k in range(4, 8)} == {"encoder failed: bad batch"}
    assert all(len(r.vector) == 2 for r in rows.values())
    models = {"m1": ModelSpec("m1", "one", 2)}
    tasks = texts.select("id", "year", F.lit("m1").alias("model_key"))
    papers = _papers(spark, 8).coalesce(1)
    literal = run_tasks(papers, tasks, models, {"m1": _moody()}, output=folder("v"), batch_size=4)
    assert literal.status.filter("status = 'failed'").count() == 0
    strict = run_tasks(papers, tasks, models, {"m1": _moody()}, output=folder("v"), batch_size=4, nan_failed=True)
    failed = strict.vectors.filter(F.isnan("vector_sum")).count()
    assert strict.status.filter("status = 'failed'").count() == failed >= 4


def test_embed_whole_table(spark, folder):
    papers = _papers(spark, 5).withColumn("m1", F.lit("old"))
    output = folder("embedded")
    embed_whole(papers, hash_encoder(8), "m1", 8, output)
    done = spark.read.parquet(output)
    assert done.columns == ["id", "year", "title", "abstract", "m1"] and done.filter("size(m1) = 8").count() == 5
    assert embed_table(papers.limit(0), hash_encoder(8), "m1", 8).count() == 0


def test_artifacts_append_and_shared_folder(spark, folder):
    root = folder("artifacts")
    rows = spark.createDataFrame([("a", 2024, "m1", [1.0])], "id string, year int, model_key string, vector array<float>")
    write_artifacts(rows, root)
    write_artifacts(rows.withColumn("seq", F.lit(2).cast("bigint")), root)
    assert spark.read.parquet(root).count() == 2
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    assert cut_lineage(rows, "x").collect() == rows.collect()
