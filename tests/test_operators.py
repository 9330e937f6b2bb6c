"""Deduplication, merging, backlog, split, overlay and reports against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from paperloom.operators.align import add_missing, cast_models, replace_column, united
from paperloom.operators.backlog import backlog, backlog_wide, state_counts
from paperloom.operators.dedup import keep_first, keep_last, latest, new_wins
from paperloom.operators.overlay import add_vector, overlay, to_long, update_vector, wide_view
from paperloom.operators.split import split_summary, split_tasks
from paperloom.operators.status import failure_head, failure_top, remaining, task_summary, with_model
from paperloom.operators.upsert import change_counts, merge_latest
from paperloom.operators.years import select_years, split_valid, with_year
from paperloom.schema import PAPER_SCHEMA, ModelSpec
from pyspark.sql import functions as F

NAN = float("nan")
MODELS = {"m1": ModelSpec("m1", "one", 2), "m2": ModelSpec("m2", "two", 2)}


def _versions(n=2000, ids=300, seed=1):
    """Versions of papers; a third of all rows belong to one id."""
    rng = random.Random(seed)
    dates = [None, "2024-01-01", "2024-01-01T00:00:00Z", "2024-02-01", "2023-05-05"]
    return [(f"p{0 if rng.random() < 1 / 3 else rng.randrange(ids)}", k, rng.choice(dates)) for k in range(n)]


@pytest.mark.parametrize("nulls", ["last", "first"])
def test_latest(spark, nulls):
    rows = _versions()
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    top = "~" if nulls == "first" else ""
    expected = set()
    for group in groups.values():
        best = max((r[2] or top) for r in group)
        expected.add(min((r for r in group if (r[2] or top) == best), key=lambda r: r[1]))
    df = spark.createDataFrame(rows, "id string, seq long, updated string").repartition(5)
    once = latest(df, nulls=nulls, tie=("seq",))
    assert set(map(tuple, once.collect())) == expected
    assert set(map(tuple, latest(once, nulls=nulls, tie=("seq",)).collect())) == expected


def test_latest_breaks_ties_the_same_way_every_time(spark):
    rows = [("a", t, "2024") for t in "xyzuvw"] * 3
    frames = [spark.createDataFrame(random.sample(rows, len(rows)), "id string, t string, updated string") for _ in range(3)]
    picked = {latest(df.repartition(k + 1)).first().t for k, df in enumerate(frames)}
    assert len(picked) == 1


def test_keep_first_last_and_new_wins(spark):
    rows = _versions()
    df = spark.createDataFrame(rows, "id string, seq long, updated string")
    first, last = {}, {}
    for row in rows:
        first.setdefault(row[0], row)
        last[row[0]] = row
    assert {tuple(r) for r in keep_first(df).collect()} == set(first.values())
    assert {tuple(r) for r in keep_last(df).collect()} == set(last.values())
    new_rows = [(i, s, "new") for i, s, _ in _versions(500, 600, seed=2)]
    new = spark.createDataFrame(new_rows, "id string, seq long, updated string")
    expected = {**last, **{r[0]: r for r in new_rows}}
    assert {tuple(r) for r in new_wins(df, new).collect()} == set(expected.values())
    keyed = new_wins(keep_last(df), new, existing_keyed=True)
    assert {tuple(r) for r in keyed.collect()} == set(expected.values())


@pytest.mark.parametrize("nulls", ["last", "first"])
def test_merge_latest_equals_union_dedup(spark, nulls):
    old = latest(spark.createDataFrame(_versions(), "id string, seq long, updated string"), tie=("seq",))
    new = spark.createDataFrame(_versions(800, 500, seed=3), "id string, seq long, updated string")
    new = new.withColumn("seq", F.col("seq") + 10_000)
    split = merge_latest(old, new, nulls=nulls, tie=("seq",))
    whole = merge_latest(old, new, nulls=nulls, tie=("seq",), existing_keyed=False)
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    counts = change_counts(old, split).first()
    assert counts.inserted == counts.net_growth == split.count() - old.count()
    assert counts.inserted + counts.updated + counts.unchanged == split.count()


def test_alignment(spark):
    a = spark.createDataFrame([("x", [1.0, 2.0], 1)], "id string, m1 array<double>, extra int")
    b = spark.createDataFrame([("y", "t")], "id string, title string")
    left, right = united(a, b, MODELS, fill="zero")
    assert left.columns == right.columns == ["id", "m1", "extra", "title", "m2"]
    rows = {r.id: r for r in left.unionByName(right).collect()}
    assert rows["x"].m1 == [1.0, 2.0] and rows["x"].m2 == [0.0, 0.0]
    assert rows["y"].m1 == [0.0, 0.0] and rows["y"].extra is None and rows["y"].title == "t"
    assert dict(left.dtypes)["m1"] == "array<float>"
    assert add_missing(b, PAPER_SCHEMA).columns == PAPER_SCHEMA.fieldNames()
    assert replace_column(a, "m1", F.lit(5)).columns == ["id", "extra", "m1"]
    with pytest.raises(Exception, match="vector length"):
        cast_models(spark.createDataFrame([([1.0],)], "m1 array<float>"), MODELS).collect()


def test_years(spark):
    rows = [("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-01"), ("c", None)]
    df = spark.createDataFrame(rows, "id string, created string")
    valid, invalid = split_valid(with_year(df))
    assert [r.id for r in valid.collect()] == ["a"] and {r.id for r in invalid.collect()} == {"b", "c"}
    assert {r.year for r in with_year(df, 2020).collect()} == {2020}
    years = spark.range(1995, 2031).select(F.col("id").cast("int").alias("year"))
    assert [r.year for r in select_years(years, " 202 , 1999").orderBy("year").collect()] == [1999, *range(2020, 2030)]
    assert select_years(years, "202", exact=True).count() == 0
    assert select_years(years).count() == 36


VECTORS = [
    ("ok", 2024, [1.0, 2.0]), ("zero", 2024, [0.0, 0.0]), ("nan", 2024, [NAN, NAN]),
    ("cancel", 2024, [1.0, -1.0]), ("null", 2024, None),
]


def test_backlog_long_and_wide_agree(spark):
    wide = spark.createDataFrame(VECTORS + [("other", 2023, [1.0, 1.0])], "id string, year int, m1 array<float>")
    papers = wide.select("id", "year")
    long = to_long(wide, ["m1"]).withColumn("seq", F.lit(1).cast("bigint"))
    for retry in (False, True):
        expected = {(i, "m1") for i in ("zero", "cancel", "null")} | {(r[0], "m2") for r in wide.collect()}
        if retry:
            expected.add(("nan", "m1"))
        from_long = backlog(papers, long, MODELS, retry)
        from_wide = backlog_wide(wide, MODELS, retry)
        assert Counter((r.id, r.model_key) for r in from_long.collect()) == Counter(expected)
        assert Counter((r.id, r.model_key) for r in from_wide.collect()) == Counter(expected)


def test_backlog_looks_at_the_newest_vector_only(spark):
    papers = spark.createDataFrame([("a", 2024), ("b", 2024)], "id string, year int")
    rows = [("a", 2024, "m1", [1.0, 1.0], 1), ("a", 2024, "m1", None, 2),
            ("b", 2024, "m1", None, 1), ("b", 2024, "m1", [1.0, 1.0], 2)]
    vectors = spark.createDataFrame(rows, "id string, year int, model_key string, vector array<float>, seq long")
    one = {"m1": MODELS["m1"]}
    assert [r.id for r in backlog(papers, vectors, one).collect()] == ["a"]
    view = {r.id: r.m1 for r in wide_view(papers, vectors, one).collect()}
    assert view == {"a": None, "b": [1.0, 1.0]}


def test_state_counts(spark):
    wide = spark.createDataFrame(VECTORS, "id string, year int, m1 array<float>")
    counts = {r.model_key: (r.row_count, r.null_count, r.near_zero_count) for r in state_counts(wide, MODELS).collect()}
    assert counts == {"m1": (5, 1, 2), "m2": (5, 5, 0)}


def _tasks(spark, ids):
    return spark.createDataFrame([(i, 2024, "m1") for i in ids], "id string, year int, model_key string")


@pytest.mark.parametrize("n, lists, cap", [(100, 10, None), (101, 10, None), (3, 10, None), (100, 7, 5), (11, 10, None), (1, 1, 1)])
@pytest.mark.parametrize("unique", [True, False])
def test_split_is_a_partition_of_its_input(spark, n, lists, cap, unique):
    tasks = _tasks(spark, [f"p{k}" for k in range(n)])
    rows = split_tasks(tasks, lists, cap, unique=unique, bucket_digits=1).collect()
    per = min(-(-n // lists), cap or n)
    assigned = min(n, per * lists)
    assert sorted(r.task_rank for r in rows) == list(range(assigned))
    assert len({r.id for r in rows}) == assigned and {r.task_total for r in rows} == {n}
    assert all(r.matrix_id == r.task_rank // per for r in rows)
    summary = split_summary(split_tasks(tasks, lists, cap)).first()
    assert (summary.total_tasks, summary.assigned_tasks, summary.dropped_tasks) == (n, assigned, n - assigned)
    assert summary.matrix_count == -(-assigned // per)


def test_split_spreads_many_copies_of_one_task(spark):
    hot = spark.range(25_000).select(F.lit("hot").alias("id"), F.lit(2024).alias("year"), F.lit("m1").alias("model_key"))
    tasks = hot.unionByName(_tasks(spark, [f"p{k}" for k in range(500)]))
    result = split_tasks(tasks, 10)
    assert result.agg(F.count_distinct("task_rank"), F.max("task_rank"), F.count("*")).first()[:] == (25_500, 25_499, 25_500)
    assert {r.n for r in result.groupBy("matrix_id").agg(F.count("*").alias("n")).collect()} == {2_550}
    assert result.filter("id = 'hot'").count() == 25_000


def test_split_of_nothing(spark):
    empty = split_tasks(_tasks(spark, []))
    assert empty.count() == 0
    assert split_summary(empty).first()[:] == (0, 0, 0, 0, "[]")


def test_split_depends_on_the_seed_only(spark):
    tasks = _tasks(spark, [f"p{k}" for k in range(200)])
    order = lambda df: {r.id: r.matrix_id for r in df.collect()}
    assert order(split_tasks(tasks)) == order(split_tasks(tasks.repartition(7), unique=True, bucket_digits=2))
    assert order(split_tasks(tasks)) != order(split_tasks(tasks, seed=7))


def test_overlay_equals_applying_artifacts_in_turn(spark):
    papers = spark.createDataFrame(
        [("a", 1, [9.0]), ("b", 1, [8.0]), ("c", 1, None), ("a", 2, [7.0])], "id string, year int, m1 array<float>"
    )
    rows = [
        ("a", 1, "m1", [1.0], 1), ("a", 1, "m1", [2.0], 3), ("a", 1, "m1", None, 4), ("b", 1, "m1", [NAN], 2),
        ("c", 1, "m2", [5.0], 1), ("x", 1, "m1", [6.0], 1),
    ]
    artifacts = spark.createDataFrame(rows, "id string, year int, model_key string, vector array<float>, seq long")
    turn = papers.withColumn("m2", F.lit(None).cast("array<float>"))
    for seq in (1, 2, 3, 4):
        for key in ("m1", "m2"):
            one = artifacts.filter((F.col("seq") == seq) & (F.col("model_key") == key))
            turn = update_vector(turn, one, key)
    plain = lambda df: sorted(map(str, df.select("id", "year", "m1", "m2").collect()))
    assert plain(overlay(papers, artifacts, ["m1", "m2"])) == plain(turn)
    kept = {(r.id, r.year): r.m1 for r in overlay(papers, artifacts, ["m1"], ignore_nan=True).collect()}
    assert kept == {("a", 1): [2.0], ("b", 1): [8.0], ("c", 1): None, ("a", 2): [7.0]}
    assert add_vector(papers, artifacts.filter("model_key = 'm2'"), "m2").filter("m2 is not null").count() == 1


def test_failure_reports(spark):
    long = "x" * 150
    errors = [long + "1", long + "2", None, None, None] + [f"r{k:02d}" for k in range(12)]
    failed = spark.createDataFrame([(f"p{k}", 1, "m1", e) for k, e in enumerate(errors)], "id string, year int, model_key string, error string")
    top = [(r.reason, r.failure_count) for r in failure_top(failed).collect()]
    assert top[:2] == [("Unknown error", 3), ("x" * 100, 2)] and len(top) == 10
    assert [r[0] for r in top[2:]] == [f"r{k:02d}" for k in range(8)]
    assert len(failure_head(failed).collect()) == 10


def test_summary_of_no_attempts(spark):
    empty = spark.createDataFrame([], "status string")
    assert task_summary(empty).first()[:] == (0, 0, 0, 0.0, False)


def test_model_lookup_and_remaining(spark):
    tasks = spark.createDataFrame([("a", 1, "m1"), ("b", 1, "zz")], "id string, year int, model_key string")
    rows = {r.id: (r.model_name, r.error) for r in with_model(tasks, MODELS).collect()}
    assert rows == {"a": ("one", None), "b": (None, "no configuration for model zz")}
    assert {r.error is not None for r in with_model(tasks, {}).collect()} == {True}
    assert [r.id for r in remaining(tasks, tasks.filter("id = 'a'")).collect()] == ["b"]
