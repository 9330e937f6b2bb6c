"""Task outcomes and the reports made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.vectors import needs_vector_sum, preview, vector_sum
from paperloom.operators.split import order_key
from paperloom.schema import ModelSpec

TASK_KEYS = ("id", "year", "model_key")

# Fixed values of the failure report.
REASON_LENGTH = 100
TOP_REASONS = 10
FIRST_DETAILS = 10
UNKNOWN_REASON = "Unknown error"

MISSING_OUTPUT = "no vector was produced for this id"
MISSING_PAPER = "id is not in the table for this year"
ENGINE_FAILED = "encoder stopped before this task"


def unconfigured(model_key: Column | str = "model_key") -> Column:
    key = F.col(model_key) if isinstance(model_key, str) else model_key
    return F.concat(F.lit("no configuration for model "), key)


def with_model(tasks: DataFrame, models: Mapping[str, ModelSpec]) -> DataFrame:
    """Add ``model_name`` and ``error`` (set when the model has no name).

    The registry is configuration, so it travels inside the expression.
    """
    names = [F.lit(x) for spec in models.values() if spec.name for x in (spec.key, spec.name)]
    name = F.try_element_at(F.create_map(*names), F.col("model_key")) if names else F.lit(None)
    tagged = tasks.withColumn("model_name", name.cast("string"))
    return tagged.withColumn("error", F.when(F.col("model_name").isNull(), unconfigured()))


def tasks_of_papers(papers: DataFrame, tasks: DataFrame, on: Sequence[str] = ("id", "year")) -> DataFrame:
    """Papers named by at least one task."""
    return papers.join(tasks.select(*on), list(on), "left_semi")


def unprocessed(
    tasks: DataFrame, output: DataFrame, on: Sequence[str] = TASK_KEYS, reason: str = MISSING_OUTPUT
) -> DataFrame:
    """Tasks without an output row, with the reason as ``error``."""
    return tasks.join(output.select(*on), list(on), "left_anti").withColumn("error", F.lit(reason))


def remaining(
    tasks: DataFrame, status: DataFrame, on: Sequence[str] = TASK_KEYS, reason: str = ENGINE_FAILED
) -> DataFrame:
    """Tasks that are in neither the processed nor the failed log."""
    return unprocessed(tasks, status, on, reason)


def step_counts(**steps: DataFrame) -> DataFrame:
    """Rows of each named step, as one table."""
    counts = [
        df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("row_count")) for name, df in steps.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def per_source(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("record_count"))


def per_model_year(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("model_key", "year").agg(F.count(F.lit(1)).alias("task_count"))


def model_keys(tasks: DataFrame) -> DataFrame:
    return tasks.select("model_key").distinct()


def task_summary(status: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempted, succeeded, failed, success percentage, and whether anything failed."""
    ok, failed = F.col("status") == "processed", F.col("status") == "failed"
    attempted = F.count(F.lit(1))
    percent = F.try_divide(F.lit(100.0) * F.count_if(ok), attempted)
    return status.groupBy(*by).agg(
        attempted.alias("attempted"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(failed).alias("failed"),
        F.coalesce(percent, F.lit(0.0)).alias("success_percent"),
        F.coalesce(F.bool_or(failed), F.lit(False)).alias("any_failed"),
    )


def failure_top(failed: DataFrame, n: int = TOP_REASONS) -> DataFrame:
    """Most frequent failure reasons by their first 100 characters; ties go by reason."""
    reason = F.substring(F.coalesce(F.col("error"), F.lit(UNKNOWN_REASON)), 1, REASON_LENGTH)
    counted = failed.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("failure_count"))
    return counted.orderBy(F.col("failure_count").desc(), F.col("reason")).limit(n)


def failure_head(failed: DataFrame, order: Sequence[str] = TASK_KEYS, n: int = FIRST_DETAILS) -> DataFrame:
    return failed.orderBy(*order).limit(n)


def sample_finished(papers: DataFrame, key: str, n: int = 5, seed: int = 42, retry_nan: bool = False) -> DataFrame:
    """Up to ``n`` seeded sample rows that need no work: id, first elements and vector sum."""
    summed = papers.select("id", F.col(f"`{key}`").alias("__v"), vector_sum(f"`{key}`").alias("vector_sum"))
    finished = summed.filter(~needs_vector_sum("vector_sum", retry_nan))
    chosen = finished.orderBy(order_key(["id"], seed), "id").limit(n)
    return chosen.select("id", preview("__v").alias("preview"), "vector_sum")
