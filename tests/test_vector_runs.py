"""Histories of runs: commits, two-phase choice, compaction, and encoding runs that go on after a failure."""

import os

import paperloom.plans.embedding as embedding
import pytest
from paperloom.operators.backlog import backlog
from paperloom.operators.embed import hash_encoder
from paperloom.operators.overlay import overlay, wide_view
from paperloom.plans import merge_increment, run_ledgered, run_tasks
from paperloom.schema import ModelSpec
from paperloom.sinks.tables import write_artifacts, write_years
from paperloom.sources.tables import next_seq, read_vectors, read_years
from paperloom.vector_runs import ConcurrentChange, append_run, compact, create_runs, drop_runs, live_runs, newest_rows, publish, read_runs, write_part
from pyspark.sql import functions as F

MODELS = {"m1": ModelSpec("m1", "one", 8), "m2": ModelSpec("m2", "two", 4)}
SCHEMA = "id string, year int, model_key string, vector array<float>"


def _vectors(spark, rows):
    table = spark.createDataFrame([(i, 2024, "m1", v) for i, v in rows], SCHEMA)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return table.withColumn("vector_sum", total)


def _papers(spark, n=40):
    return spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("id"), F.lit(2024).alias("year"),
        F.concat(F.lit("title "), "id").alias("title"), F.lit("text").alias("abstract"), F.lit(None).cast("string").alias("updated"),
    )


def _newest(spark, root):
    return sorted((r.id, r.vector) for r in newest_rows(spark, root).collect())


@pytest.fixture
def root(spark, folder):
    path = folder("runs")
    create_runs(spark, path)
    return path


def test_runs_get_their_place_by_their_commit(spark, root):
    assert read_vectors(spark, root).count() == 0 and next_seq(spark, root) == 1
    assert append_run(_vectors(spark, [("a", [1.0]), ("b", [2.0])]), root) == 1
    write_artifacts(_vectors(spark, [("a", [3.0]), ("c", None)]).withColumn("seq", F.lit(99)), root)
    assert _newest(spark, root) == [("a", [3.0]), ("b", [2.0]), ("c", None)]
    assert {(r.id, r.seq) for r in read_vectors(spark, root).collect()} == {("a", 1), ("b", 1), ("a", 2), ("c", 2)}
    # A run that dies before its commit is not seen.
    write_part(_vectors(spark, [("a", [9.0])]), root, "r-dead", "p-all")
    assert _newest(spark, root)[0] == ("a", [3.0])
    assert drop_runs(spark, root) == 1 and _newest(spark, root)[0] == ("a", [3.0])
    with pytest.raises(ValueError, match="already"):
        create_runs(spark, root)


def test_vectors_are_neither_sorted_nor_aggregated(spark, root):
    for k in range(3):
        append_run(_vectors(spark, [(f"a{j}", [float(k + j)]) for j in range(k, 30)]), root)
    plan = newest_rows(spark, root)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Sort" in x or "Aggregate" in x]
    assert lines and not any("vector#" in x for x in lines) and "ShuffledHashJoin" in plan
    assert _newest(spark, root) == sorted((f"a{j}", [float(min(j, 2) + j)]) for j in range(30))


def test_compaction_changes_nothing_that_is_read(spark, root):
    papers, models = _papers(spark), {"m1": MODELS["m1"]}
    for k in range(6):
        append_run(_vectors(spark, [(f"p{j}", [float(10 * k + j + 1)] * 8) for j in range(k, 40, k + 1)]), root)
    append_run(_vectors(spark, [("p3", None), ("p4", [0.0] * 8), ("gone", None)]), root)

    def seen():
        vectors = read_vectors(spark, root)
        wide = sorted((r.id, r.m1) for r in wide_view(papers, vectors, models).collect())
        return sorted(map(str, backlog(papers, vectors, models).collect())), wide

    before = seen()
    assert compact(spark, root) == len([v for _, v in _newest(spark, root) if v]) == 39
    assert seen() == before and len(live_runs(spark, root)[1]) == 1
    files = [n for _, _, names in os.walk(f"{root}/runs") for n in names if n.endswith(".parquet")]
    drop_runs(spark, root)
    left = [n for _, _, names in os.walk(f"{root}/runs") for n in names if n.endswith(".parquet")]
    assert seen() == before and len(left) <= 2 < len(files)
    append_run(_vectors(spark, [("p3", [5.0] * 8)]), root)
    assert dict(_newest(spark, root))["p3"] == [5.0] * 8
    assert compact(spark, root) == 40 and dict(_newest(spark, root))["p3"] == [5.0] * 8


def test_runs_appended_while_a_compaction_works_stay(spark, root, monkeypatch):
    append_run(_vectors(spark, [("a", [1.0]), ("b", [1.0])]), root)
    append_run(_vectors(spark, [("b", [2.0])]), root)
    import paperloom.vector_runs as runs

    real, during = runs.write_part, []

    def slow(*args, **options):
        real(*args, **options)
        if not during:
            during.append(True)
            append_run(_vectors(spark, [("a", [7.0])]), root)

    monkeypatch.setattr(runs, "write_part", slow)
    assert compact(spark, root) == 2
    assert _newest(spark, root) == [("a", [7.0]), ("b", [2.0])] and len(live_runs(spark, root)[1]) == 2
    _, old = live_runs(spark, root)
    compact(spark, root)
    with pytest.raises(ConcurrentChange):
        publish(spark, root, "r-late", ["p-compact"], replaced=old)
    assert compact(spark, root) == 2


def _tasks(papers):
    return papers.select("id", "year", F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("model_key"))


def test_a_run_that_died_goes_on_with_what_is_left(spark, root, monkeypatch):
    papers = _papers(spark)
    tasks = _tasks(papers).unionByName(spark.createDataFrame([("none", 2024, "m1"), ("p1", 2024, "m9")], "id string, year int, model_key string"))
    encoders = {"m1": hash_encoder(8), "m2": hash_encoder(4)}
    real, written = embedding.write_part, []

    def dying(*args, **options):
        if len(written) == 6:
            raise RuntimeError("the driver dies in the second model")
        written.append(args[3])
        return real(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(embedding, "write_part", dying)
        with pytest.raises(RuntimeError, match="dies"):
            run_ledgered(papers, tasks, MODELS, encoders, root, "nightly", slices=4)
    assert read_vectors(spark, root).count() == 0

    def one(dim):
        return lambda: lambda texts: [[0.5] * dim for _ in texts]

    # The second call encodes only what is left, from the stored work: other papers and tasks do not matter.
    run = run_ledgered(papers.limit(0), tasks.limit(0), MODELS, {"m1": one(8), "m2": one(4)}, root, "nightly", slices=2)
    rows = run.vectors.collect()
    assert len(rows) == 80 and len({(r.id, r.model_key) for r in rows}) == 80
    assert all(r.vector != [0.5] * 8 for r in rows if r.model_key == "m1")
    fresh = [r for r in rows if r.vector == [0.5] * 4]
    assert 0 < len(fresh) < 40
    status = {(r.id, r.model_key): (r.status, r.error) for r in run.status.collect()}
    assert len(status) == 82 and status["none", "m1"][0] == status["p1", "m9"][0] == "failed"
    assert sum(s == "processed" for s, _ in status.values()) == 80
    assert {r.seq for r in rows} == {1}
    again = run_ledgered(papers, tasks, MODELS, encoders, root, "nightly", slices=4)
    assert again.vectors.count() == 80 and len(live_runs(spark, root)[1]) == 1
    assert backlog(papers, read_vectors(spark, root), MODELS).isEmpty()


def test_an_encoder_that_did_not_start_is_taken_up_again(spark, root):
    papers = _papers(spark, 10)

    def broken():
        raise OSError("no device")

    first = run_ledgered(papers, _tasks(papers), MODELS, {"m1": hash_encoder(8), "m2": broken}, root, "r1", slices=2)
    assert first.status.filter("status = 'failed'").count() == 10 and first.vectors.count() == 10
    second = run_ledgered(papers, _tasks(papers), MODELS, {"m1": hash_encoder(8), "m2": hash_encoder(4)}, root, "r1", slices=2)
    assert second.status.filter("status = 'processed'").count() == 20 and second.vectors.count() == 20


def test_a_history_of_runs_serves_the_other_jobs(spark, root, folder):
    table = folder("table")
    write_years(_papers(spark, 6), table)
    papers = read_years(spark, table)
    done = run_tasks(papers, _tasks(papers), MODELS, {"m1": hash_encoder(8), "m2": hash_encoder(4)}, output=root)
    assert done.vectors.count() == 12 and done.status.filter("status = 'processed'").count() == 12
    changed = spark.createDataFrame([("p1", "new", "2024-02-01")], "id string, title string, updated string")
    merge_increment(spark, changed, table, 2024, vectors_root=root, models=MODELS)
    assert {(r.id, r.model_key) for r in backlog(read_years(spark, table), read_vectors(spark, root), MODELS).collect()} == {("p1", "m1"), ("p1", "m2")}
    assert read_runs(spark, root, []).count() == 0


def test_newest_vectors_are_joined_without_being_aggregated(spark, root):
    papers = _papers(spark, 6)
    append_run(_vectors(spark, [(f"p{k}", [float(k)]) for k in range(5)]), root)
    append_run(_vectors(spark, [("p1", [9.0]), ("p2", None), ("p3", [float("nan")]), ("other", [1.0])]), root)
    stored = papers.withColumn("m1", F.array(F.lit(7.0).cast("float")))
    slow = overlay(stored, read_vectors(spark, root), ["m1", "m2"], skip_null=False)
    fast = overlay(stored, newest_rows(spark, root), ["m1", "m2"], skip_null=False, unique=True)
    assert sorted(map(str, slow.collect())) == sorted(map(str, fast.collect()))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert not any("vector#" in x for x in plan.splitlines() if "Aggregate" in x)
