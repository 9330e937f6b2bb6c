"""Which (paper, model) pairs still lack a usable vector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.vectors import needs_vector, needs_vector_sum, near_zero_sum, newest_first, vector_sum
from paperloom.schema import ModelSpec


def dimensioned(models: Mapping[str, ModelSpec]) -> list[str]:
    """Model keys with a registered length; only these get a backlog."""
    keys = [key for key, spec in models.items() if spec.dimension]
    if not keys:
        raise ValueError("no registered model has a dimension")
    return keys


def _explode_missing(df: DataFrame, missing: Mapping[str, Column]) -> DataFrame:
    """One task per row and model whose flag is true: a projection, no join."""
    tagged = F.array(*[F.when(flag, F.lit(key)) for key, flag in missing.items()])
    return df.select("id", "year", F.explode(F.array_compact(tagged)).alias("model_key"))


def backlog(
    papers: DataFrame,
    vectors: DataFrame,
    models: Mapping[str, ModelSpec],
    retry_nan: bool = False,
) -> DataFrame:
    """Tasks ``(id, year, model_key)`` whose newest vector row is missing or unusable.

    ``vectors`` is the long table; of it only the keys, ``seq`` and ``vector_sum`` are
    read. Its rows fold into one flag per paper and model before they are joined, so
    papers are shuffled once, whatever the number of models.
    """
    keys = dimensioned(models)
    total = F.col("vector_sum") if "vector_sum" in vectors.columns else vector_sum("vector")
    state = vectors.filter(F.col("model_key").isin(keys)).select(
        "id", "year", "model_key", newest_first("seq", total.isNull(), total).alias("place"),
        (~needs_vector_sum(total, retry_nan)).alias("usable"),
    )
    flags = [
        F.max_by("usable", F.when(F.col("model_key") == key, F.col("place"))).alias(f"__has_{key}")
        for key in keys
    ]
    usable = state.groupBy("id", "year").agg(*flags)
    joined = papers.select("id", "year").join(usable, ["id", "year"], "left")
    missing = {k: ~F.coalesce(F.col(f"`__has_{k}`"), F.lit(False)) for k in keys}
    return _explode_missing(joined, missing)


def backlog_wide(papers: DataFrame, models: Mapping[str, ModelSpec], retry_nan: bool = False) -> DataFrame:
    """The same tasks from a table with one column per model: one scan, no shuffle.

    A model without a column needs every paper.
    """
    missing = {
        key: needs_vector(f"`{key}`", retry_nan) if key in papers.columns else F.lit(True)
        for key in dimensioned(models)
    }
    return _explode_missing(papers, missing)


def potential_tasks(papers: DataFrame, models: Mapping[str, ModelSpec]) -> DataFrame:
    """Rows × models, as an upper bound of the backlog."""
    count = len(dimensioned(models))
    return papers.agg((F.count(F.lit(1)) * count).alias("potential_tasks"))


def state_counts(papers: DataFrame, models: Mapping[str, ModelSpec]) -> DataFrame:
    """Per year and model: rows, null vectors and near-zero vectors, in one pass."""
    entries = []
    for key in dimensioned(models):
        total = vector_sum(f"`{key}`") if key in papers.columns else F.lit(None).cast("double")
        entries.append(F.struct(F.lit(key).alias("model_key"), total.alias("total")))
    states = papers.select("year", F.inline(F.array(*entries)))
    return states.groupBy("year", "model_key").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("total").isNull()).alias("null_count"),
        F.count_if(near_zero_sum("total")).alias("near_zero_count"),
    )
