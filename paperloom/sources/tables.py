"""Yearly tables, artifacts and task lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.text import _col
from paperloom.operators.years import touched_years
from paperloom.schema import TASK_SCHEMA, VECTOR_SCHEMA, yearly_schema
from paperloom.vector_runs import is_runs, live_runs, read_runs
from paperloom.versions import Parts, Snapshot, is_versioned, read_table, snapshot, touched_parts

# How artifact and task files are named.
ARTIFACT_NAME = r"embedded-([0-9]+)\.parquet-(.+?)\.parquet"
ARTIFACT_GLOB = "matrix-output-*/embedded-*.parquet-{key}.parquet"
MATRIX_NAME = r"matrix-output-([0-9]+)"


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether a non-empty folder exists at ``path`` on the table's file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def read_years(
    spark: SparkSession,
    root: str,
    years: Iterable[int] | None = None,
    model_keys: Iterable[str] | None = None,
) -> DataFrame:
    """The yearly table at ``root``, or only the folders of ``years``.

    Years may differ in their model columns; the result has those of all files read, and
    nulls where a file lacks one. Naming ``model_keys`` fixes the schema instead, which
    saves reading the file footers first. A versioned table knows its schema.
    """
    if is_versioned(spark, root):
        schema = None if model_keys is None else yearly_schema(model_keys)
        return read_table(spark, root, None if years is None else {y: None for y in years}, schema=schema)
    reader = spark.read.option("basePath", root).option("mergeSchema", "true")
    if model_keys is not None:
        reader = reader.schema(yearly_schema(model_keys))
    if years is None:
        return reader.parquet(root)
    folders = [f"{root}/year={y}" for y in years if is_table(spark, f"{root}/year={y}")]
    if folders:
        return reader.parquet(*folders)
    return reader.option("mergeSchema", "false").parquet(root).limit(0)


def has_year(spark: SparkSession, root: str, year: int) -> bool:
    """Whether the yearly table has rows of a year."""
    if is_versioned(spark, root):
        return year in snapshot(spark, root).years
    return is_table(spark, f"{root}/year={year}")


def table_state(spark: SparkSession, root: str) -> Snapshot | None:
    """The commit a job on a versioned table starts from; None for a plain table."""
    return snapshot(spark, root) if is_versioned(spark, root) else None


def touched(batch: DataFrame, state: Snapshot | None) -> Parts:
    """What a job has to read and replace for a batch: parts of a versioned table, or whole years of a plain one."""
    return {y: None for y in touched_years(batch)} if state is None else touched_parts(batch, state.buckets)


def read_touched(spark: SparkSession, root: str, parts: Parts, state: Snapshot | None) -> DataFrame:
    """The stored rows of ``parts``."""
    if state is None:
        return read_years(spark, root, sorted(parts))
    return read_table(spark, root, parts, state.number)


def read_vectors(spark: SparkSession, root: str) -> DataFrame:
    """The long vector table at ``root``, without rows if nothing was written there yet."""
    if is_runs(spark, root):
        return read_runs(spark, root)
    if not is_table(spark, root):
        return spark.createDataFrame([], VECTOR_SCHEMA)
    return spark.read.schema(VECTOR_SCHEMA).parquet(root)


def next_seq(spark: SparkSession, root: str) -> int:
    """The next free place in the vector history at ``root``; a history of runs gives places itself."""
    if is_runs(spark, root):
        return live_runs(spark, root)[0] + 1
    newest = read_vectors(spark, root).agg(F.max("seq")).first()[0]
    return 0 if newest is None else newest + 1


def artifact_year(name: Column | str) -> Column:
    return F.regexp_extract(_col(name), ARTIFACT_NAME, 1).cast("int")


def artifact_model(name: Column | str) -> Column:
    return F.regexp_extract(_col(name), ARTIFACT_NAME, 2)


def _has_match(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def read_artifacts(spark: SparkSession, root: str, model_keys: Iterable[str]) -> DataFrame:
    """Named artifact files as long rows ``(id, year, model_key, vector, seq)``.

    Files of different models have different columns, so each registered model is one
    scan; a model without any file has no rows. A null vector in a file says nothing and
    is left out. ``seq`` is the number of the work list, which is the order they are
    applied in.
    """
    model_keys = list(model_keys)
    if not model_keys:
        raise ValueError("name at least one model")
    out = None
    for key in model_keys:
        if not _has_match(spark, f"{root}/{ARTIFACT_GLOB.format(key=key)}"):
            continue
        path = F.col("_metadata.file_path")
        rows = (
            spark.read.schema(f"id string, `{key}` array<float>")
            .parquet(f"{root}/{ARTIFACT_GLOB.format(key=key)}")
            .select(
                "id",
                artifact_year(path).alias("year"),
                F.lit(key).alias("model_key"),
                F.col(f"`{key}`").alias("vector"),
                F.regexp_extract(path, MATRIX_NAME, 1).cast("bigint").alias("seq"),
            )
            .filter("vector is not null")
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], "id string, year int, model_key string, vector array<float>, seq bigint")
    return out


def read_tasks(spark: SparkSession, path: str, matrix_id: int | None = None) -> DataFrame:
    """Tasks written by the split, one JSON object per line; ``matrix_id`` selects one list."""
    source = path if matrix_id is None else f"{path}/matrix_id={matrix_id}"
    return spark.read.schema(TASK_SCHEMA).json(source)


def read_task_array(spark: SparkSession, path: str) -> DataFrame:
    """Externally made task files, each one JSON array of ``{id, year_file, model_key}``."""
    rows = spark.read.schema("id string, year_file string, model_key string").json(path, multiLine=True)
    return rows.select("id", F.regexp_extract("year_file", r"([0-9]+)", 1).cast("int").alias("year"), "model_key")
