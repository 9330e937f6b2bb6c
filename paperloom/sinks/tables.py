"""Writers for yearly tables, vectors, task lists and task logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from paperloom.operators.status import failure_head, failure_top, task_summary
from paperloom.schema import VECTOR_SCHEMA
from paperloom.session import drop_scratch, scratch_dir
from paperloom.vector_runs import append_run, is_runs
from paperloom.versions import Parts, Snapshot, is_versioned, replace_parts

# Parts a year is hashed into before adaptive execution evens out their sizes.
_YEAR_PARTS = 16


def _sorted_by_year(df: DataFrame) -> DataFrame:
    # Adaptive execution cuts large parts of a year further and joins small ones, in one
    # pass; a range partitioning would compute the rows twice to sample them.
    parted = df.withColumn("__part", F.pmod(F.xxhash64("id"), F.lit(_YEAR_PARTS)))
    return parted.hint("rebalance", "year", "__part").drop("__part").sortWithinPartitions("year", "id")


def _write_sorted(df: DataFrame, root: str) -> int:
    seen = Observation("written")
    observed = _sorted_by_year(df).observe(seen, F.count(F.lit(1)).alias("n"))
    observed.write.mode("overwrite").partitionBy("year").option("compression", "zstd").parquet(root)
    return seen.get["n"]


def write_years(df: DataFrame, root: str, on_empty: str = "write") -> int:
    """Write a whole yearly table, zstd, sorted by id inside each year. Returns its rows.

    A large year is spread over many files. Without rows, ``on_empty="skip"`` leaves the
    path as it is and ``"write"`` leaves an empty table that has the schema.
    """
    if on_empty not in ("write", "skip"):
        raise ValueError(f"on_empty must be write or skip, not {on_empty}")
    if on_empty == "skip" and df.isEmpty():
        return 0
    written = _write_sorted(df, root)
    if written == 0:
        # Without rows there is no year folder to carry the schema.
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(root)
    return written


def write_snapshot(df: DataFrame, path: str, on_empty: str = "write") -> int:
    """Write one unpartitioned batch, zstd, in id order over all its files. Returns its rows."""
    if on_empty == "skip" and df.isEmpty():
        return 0
    seen = Observation("snapshot")
    ordered = df.repartitionByRange("id").sortWithinPartitions("id")
    ordered.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(path)
    return seen.get["n"]


def replace_touched(df: DataFrame, root: str, parts: Parts, state: Snapshot | None, staged: bool = True) -> int:
    """Make ``df`` the content of ``parts``, which were read at ``state``. Returns rows written."""
    if state is None:
        return replace_years(df, root, staged)
    return replace_parts(df, root, parts, state)


def replace_years(df: DataFrame, root: str, staged: bool = True) -> int:
    """Replace the years present in ``df`` and leave all others alone. Returns rows written.

    The result is first written to a staging table and counted there; only a complete
    staging table replaces the years. So ``df`` may read the years it replaces, and a job
    that dies leaves either the old years or a full copy of the new ones. ``staged=False``
    relies on the commit of Spark's own dynamic overwrite and saves the second write. A
    versioned table needs neither: rows are written once and its commit switches the years.
    """
    if is_versioned(df.sparkSession, root):
        return replace_parts(df, root)
    staging = None
    if staged:
        staging = scratch_dir(df.sparkSession, "staging")
        written = _write_sorted(df, staging)
        if written == 0:
            return 0
        staged_rows = df.sparkSession.read.schema(df.schema).parquet(staging)
        found = staged_rows.count()
        if found != written:
            raise RuntimeError(f"staging holds {found} of {written} rows; {root} is unchanged")
        # The staged files have their final size; only their inner order is restored.
        result = staged_rows.sortWithinPartitions("year", "id")
    else:
        result = _sorted_by_year(df)
    seen = Observation("replaced")
    writer = result.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
        "year"
    ).parquet(root)
    if staging:
        drop_scratch(df.sparkSession, staging)
    return seen.get["n"]


def write_artifacts(vectors: DataFrame, root: str, mode: str = "append") -> None:
    """Write long vector rows below ``model_key`` and ``year`` folders.

    Columns of the vector schema that ``vectors`` lacks are written as null. In a history
    of runs the rows are a run of their own, whose place is given by its commit and not by ``seq``.
    """
    if is_runs(vectors.sparkSession, root):
        append_run(vectors, root)
        return
    partitions = ["model_key", "year"]
    columns = [
        (F.col(f.name) if f.name in vectors.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in sorted(VECTOR_SCHEMA, key=lambda f: f.name in partitions)
    ]
    vectors.select(*columns).write.mode(mode).partitionBy(*partitions).option(
        "compression", "zstd"
    ).parquet(root)


def write_tasks(assigned: DataFrame, root: str) -> None:
    """Write each work list as JSON lines below its ``matrix_id`` folder.

    All folders together are the full list of assigned tasks.
    """
    tasks = assigned.select("id", "year", "model_key", "matrix_id").hint("rebalance", "matrix_id")
    tasks.write.mode("overwrite").partitionBy("matrix_id").json(root)


def write_status(status: DataFrame, root: str) -> None:
    """Write the processed and failed logs, then three summary tables made from them, as JSON."""
    log = f"{root}/tasks"
    status.write.mode("overwrite").partitionBy("status").json(log)
    written = status.sparkSession.read.schema(status.schema).json(log)
    failed = written.filter(F.col("status") == "failed")
    summaries = {
        "summary": task_summary(written),
        "top_reasons": failure_top(failed),
        "first_failures": failure_head(failed),
    }
    for name, table in summaries.items():
        table.write.mode("overwrite").json(f"{root}/{name}")
