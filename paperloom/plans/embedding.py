"""From backlog to work lists, vectors, logs and the merged table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from paperloom.functions.text import embed_text
from paperloom.operators.backlog import backlog
from paperloom.operators.embed import BATCH_SIZE, NOT_STARTED, EncoderFactory, embed, embed_table
from paperloom.operators.overlay import overlay
from paperloom.operators.split import split_summary, split_tasks
from paperloom.operators.status import (
    MISSING_PAPER,
    TASK_KEYS,
    tasks_of_papers,
    unconfigured,
)
from paperloom.files import commit_file, commit_json, commit_numbers, read_json
from paperloom.schema import TASK_SCHEMA, ModelSpec
from paperloom.session import cut_lineage, scoped, shared_dir
from paperloom.sinks.tables import replace_touched, write_artifacts, write_tasks
from paperloom.sources.tables import next_seq, read_touched, read_vectors, table_state, touched
from paperloom.vector_runs import is_runs, new_run, newest_rows, publish, read_runs, write_part

# Fixed value: number of work lists.
LISTS = 10


def assign_backlog(
    papers: DataFrame,
    vectors: DataFrame,
    models: Mapping[str, ModelSpec],
    lists: int = LISTS,
    max_per_list: int | None = None,
    seed: int = 42,
    retry_nan: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Find the backlog and split it.

    The backlog is written once to the shared folder and read by both passes of the split.
    """
    tasks = cut_lineage(backlog(papers, vectors, models, retry_nan), "backlog")
    return split_tasks(tasks, lists, max_per_list, seed, unique)


@scoped
def backlog_and_split(
    papers: DataFrame,
    vectors: DataFrame,
    models: Mapping[str, ModelSpec],
    output: str,
    lists: int = LISTS,
    max_per_list: int | None = None,
    seed: int = 42,
    retry_nan: bool = False,
) -> DataFrame:
    """Write the work lists of the backlog and return the one-row summary of the split.

    ``papers`` comes from a yearly table, whose (id, year) is unique.
    """
    assigned = assign_backlog(papers, vectors, models, lists, max_per_list, seed, retry_nan, unique=True)
    assigned = cut_lineage(assigned, "assigned")
    write_tasks(assigned, output)
    summary = split_summary(assigned)
    return papers.sparkSession.createDataFrame(summary.collect(), summary.schema)  # one row


@dataclass(frozen=True)
class TaskRun:
    """Result tables of a run: its long vectors, and one status row per task."""

    vectors: DataFrame
    status: DataFrame


def run_tasks(
    papers: DataFrame,
    tasks: DataFrame,
    models: Mapping[str, ModelSpec],
    encoders: Mapping[str, EncoderFactory],
    seq: int | None = None,
    output: str | None = None,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    nan_failed: bool = False,
) -> TaskRun:
    """Embed the papers named by ``tasks`` and log every task as processed or failed.

    Each configured model is one job: papers are first cut to that model's tasks, then
    spread over ``partitions`` encoder tasks, which load this model only. Vectors are
    appended to ``output`` once and the log is made from what was written there. ``seq`` is
    this run's place in the vector history, by default the next free one of ``output``. A
    history of runs gives the place itself; ``run_ledgered`` can go on with a run there.

    A task fails when its model is not configured, its paper is not in the table, or the
    encoder did not start. A text that could not be embedded gets a NaN vector and counts
    as processed, or with ``nan_failed`` as failed.
    """
    spark = papers.sparkSession
    root = output or shared_dir(spark, "vectors")
    if is_runs(spark, root):
        return run_ledgered(papers, tasks, models, encoders, root, new_run(), 1, batch_size, partitions, nan_failed)
    seq = next_seq(spark, root) if seq is None else seq
    texts = papers.select("id", "year", embed_text().alias("text"))
    ready = {k: m for k, m in models.items() if m.name and m.dimension and k in encoders}
    not_started = F.coalesce(F.startswith("error", F.lit(NOT_STARTED)), F.lit(False))
    stopped: dict[str, str] = {}
    for key, model in ready.items():
        seen = Observation(f"embed-{key}")
        wanted = tasks_of_papers(texts, tasks.filter(F.col("model_key") == key))
        done = embed(wanted, encoders[key], model.dimension, batch_size=batch_size, partitions=partitions)
        done = done.observe(seen, F.max(F.when(not_started, F.col("error"))).alias("problem"))
        done = done.filter(~not_started)
        write_artifacts(done.withColumns({"model_key": F.lit(key), "seq": F.lit(seq).cast("bigint")}), root)
        if seen.get["problem"]:
            stopped[key] = seen.get["problem"]

    written = read_vectors(spark, root).filter(F.col("seq") == seq)
    return TaskRun(written, task_status(tasks, written, ready, stopped, root, nan_failed))


def run_ledgered(
    papers: DataFrame,
    tasks: DataFrame,
    models: Mapping[str, ModelSpec],
    encoders: Mapping[str, EncoderFactory],
    root: str,
    run: str,
    slices: int = 8,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    nan_failed: bool = False,
) -> TaskRun:
    """``run_tasks`` into a history of runs, with a ledger from which a run that died goes on.

    The first attempt writes the run's work, each task with its text, cut into ``slices``
    per model. Every slice is a job of its own; when it is written, an entry in the ledger
    names its files. Another call with the same ``run`` takes the stored work, whatever
    papers and tasks say then, and encodes only slices without an entry. The run becomes
    visible at the end, by one commit, so each task counts once. Models whose encoder did
    not start are reported as failed and are taken up by the next call.
    """
    spark = papers.sparkSession
    ledger = f"{root}/ledger/{run}"
    attempt = 0
    while not commit_json(spark, f"{ledger}/attempts", attempt, {"run": run}):
        attempt += 1
    ready = {k: m for k, m in models.items() if m.name and m.dimension and k in encoders}
    if not commit_numbers(spark, f"{ledger}/work"):
        _land_work(papers, tasks, ledger, attempt, slices)
    place = read_json(spark, commit_file(f"{ledger}/work", 0))
    stored = spark.read.schema(TASK_SCHEMA).parquet(f"{ledger}/{place['tasks']}")
    work = spark.read.schema("id string, year int, text string, model_key string, slice int").parquet(f"{ledger}/{place['texts']}")
    not_started = F.coalesce(F.startswith("error", F.lit(NOT_STARTED)), F.lit(False))
    parts, stopped = [], {}
    for place_of_model, (key, model) in enumerate(sorted(ready.items())):
        for number in range(place["slices"]):
            entries = f"{ledger}/done/model={key}-slice={number}"
            if not commit_numbers(spark, entries):
                part = f"p-{place_of_model}-{number}-{attempt}"
                seen = Observation(f"embed-{key}-{number}")
                wanted = work.filter((F.col("model_key") == key) & (F.col("slice") == number)).select("id", "year", "text")
                done = embed(wanted, encoders[key], model.dimension, batch_size=batch_size, partitions=partitions)
                done = done.observe(seen, F.max(F.when(not_started, F.col("error"))).alias("problem"))
                write_part(done.filter(~not_started).withColumn("model_key", F.lit(key)), root, run, part)
                if seen.get["problem"]:
                    stopped[key] = seen.get["problem"]
                    break
                # Of two attempts at once the first entry counts.
                commit_json(spark, entries, 0, {"part": part})
            parts.append(read_json(spark, commit_file(entries, 0))["part"])
    publish(spark, root, run, parts)
    written = read_runs(spark, root, [run])
    return TaskRun(written, task_status(stored, written, ready, stopped, root, nan_failed))


def _land_work(papers: DataFrame, tasks: DataFrame, ledger: str, attempt: int, slices: int) -> None:
    """Write tasks, and once per task its paper's text, cut by model and slice; one entry makes both count."""
    spark = papers.sparkSession
    named = {"tasks": f"tasks-{attempt}", "texts": f"texts-{attempt}", "slices": slices}
    tasks.select("id", "year", "model_key").write.mode("overwrite").parquet(f"{ledger}/{named['tasks']}")
    stored = spark.read.schema(TASK_SCHEMA).parquet(f"{ledger}/{named['tasks']}").distinct()
    texts = papers.select("id", "year", embed_text().alias("text")).join(stored, ["id", "year"])
    cut = texts.withColumn("slice", F.pmod(F.xxhash64("id", "year"), F.lit(slices)).cast("int"))
    cut.write.mode("overwrite").partitionBy("model_key", "slice").parquet(f"{ledger}/{named['texts']}")
    commit_json(spark, f"{ledger}/work", 0, named)


def task_status(
    tasks: DataFrame,
    written: DataFrame,
    ready: Mapping[str, ModelSpec],
    stopped: Mapping[str, str],
    root: str,
    nan_failed: bool = False,
) -> DataFrame:
    """One row per task: processed, or failed with the reason.

    Encoding gives a row for every paper it is handed, so a task of a running encoder
    that left no row had no paper. The paper table need not be read again to know.
    """
    produced = written.groupBy(*TASK_KEYS).agg(F.max("error").alias("__error"), F.lit(True).alias("__done"))
    joined = tasks.select(*TASK_KEYS).join(produced, list(TASK_KEYS), "left")
    absent = F.col("__done").isNull()
    reason = F.when(~F.col("model_key").isin(list(ready)), unconfigured())
    for key, problem in stopped.items():
        reason = reason.when(absent & (F.col("model_key") == key), F.lit(problem))
    reason = reason.when(absent, F.lit(MISSING_PAPER))
    if nan_failed:
        reason = reason.otherwise(F.col("__error"))
    failed = F.col("error").isNotNull()
    return joined.select(*TASK_KEYS, reason.alias("error")).select(
        *TASK_KEYS,
        F.when(failed, "failed").otherwise("processed").alias("status"),
        "error",
        F.when(~failed, F.lit(root)).alias("output"),
    )


def embed_whole(
    papers: DataFrame,
    factory: EncoderFactory,
    key: str,
    dim: int,
    output: str,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    title: str = "title",
    abstract: str = "abstract",
) -> None:
    """Embed every row of a table and write it with all its columns."""
    done = embed_table(papers, factory, key, dim, title, abstract, batch_size, partitions)
    done.write.mode("overwrite").option("compression", "zstd").parquet(output)


@scoped
def merge_artifacts(
    spark: SparkSession,
    root: str,
    artifacts: DataFrame,
    model_keys: Sequence[str],
    ignore_nan: bool = False,
    unique: bool = False,
) -> int:
    """Overlay long artifacts onto the wide yearly table. Returns the rows rewritten.

    A newest row without vector, as forgotten papers have, clears the column. Only years
    that have artifacts are read and replaced, of a versioned table only their parts.
    ``unique`` promises one artifact per paper and model.
    """
    state = table_state(spark, root)
    parts = touched(artifacts, state)
    if not parts:
        return 0
    papers = read_touched(spark, root, parts, state)
    merged = overlay(papers, artifacts, model_keys, ignore_nan=ignore_nan, skip_null=False, unique=unique)
    return replace_touched(merged, root, parts, state)


def merge_history(spark: SparkSession, root: str, vectors_root: str, model_keys: Sequence[str], ignore_nan: bool = False) -> int:
    """Overlay the newest vectors of a history of runs onto the wide yearly table. Returns the rows rewritten.

    The newest row of each paper and model is chosen by its keys and place alone; only the
    vectors of those rows are fetched and joined. With ``ignore_nan`` a newest vector of
    NaNs leaves the stored one as it is.
    """
    newest = newest_rows(spark, vectors_root).filter(F.col("model_key").isin(list(model_keys)))
    return merge_artifacts(spark, root, newest, model_keys, ignore_nan, unique=True)
