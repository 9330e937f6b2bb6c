"""Putting vectors onto the paper table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.vectors import newest_first, vector_sum, zero_vector
from paperloom.schema import ModelSpec

KEYS = ("id", "year")
_HAS = "__has_"


def _is_nan(v: Column) -> Column:
    return F.coalesce(F.isnan(vector_sum(v)), F.lit(False))


def add_vector(papers: DataFrame, vectors: DataFrame, key: str, on: Sequence[str] = KEYS) -> DataFrame:
    """Left join one new model column; ``vectors`` holds ``on`` and ``vector``, one row per key."""
    column = vectors.select(*on, F.col("vector").alias(key))
    return papers.join(column, list(on), "left")


def update_vector(
    papers: DataFrame,
    vectors: DataFrame,
    key: str,
    on: Sequence[str] = KEYS,
    ignore_nan: bool = False,
) -> DataFrame:
    """Replace an existing model column where a new value is present, else keep the old one.

    Vectors of unknown papers are ignored. All-NaN vectors count as present unless
    ``ignore_nan``.
    """
    value = F.col("vector")
    if ignore_nan:
        value = F.when(~_is_nan(value), value)
    joined = papers.join(vectors.select(*on, value.alias("__new")), list(on), "left")
    merged = F.coalesce(F.col("__new"), F.col(f"`{key}`"))
    return joined.select(*[merged.alias(c) if c == key else F.col(f"`{c}`") for c in papers.columns])


def collapse(
    artifacts: DataFrame,
    keys: Sequence[str],
    on: Sequence[str] = KEYS,
    ignore_nan: bool = False,
    skip_null: bool = True,
) -> DataFrame:
    """One row per paper with one column per model: the last artifact vector by ``seq``.

    A null vector is passed over, or with ``skip_null=False`` hides the earlier ones and
    those of its own ``seq``; flag columns then tell which models have a row. One
    aggregation with map-side combine does both the choice and the pivot, so each vector
    is shuffled once, and repeated ids shrink before they move.
    """
    usable = F.col("vector").isNotNull() if skip_null else F.lit(True)
    if ignore_nan:
        usable = usable & ~_is_nan(F.col("vector"))
    order = newest_first("seq", F.col("vector").isNull(), F.xxhash64("vector"))
    chosen = [
        F.max_by("vector", F.when(usable & (F.col("model_key") == key), order)).alias(key) for key in keys
    ]
    if not skip_null:
        # Tells a newest row without vector from a model without any row.
        chosen += [F.bool_or(usable & (F.col("model_key") == key)).alias(f"{_HAS}{key}") for key in keys]
    return artifacts.filter(F.col("model_key").isin(list(keys))).groupBy(*on).agg(*chosen)


def overlay(
    papers: DataFrame,
    artifacts: DataFrame,
    keys: Sequence[str],
    on: Sequence[str] = KEYS,
    ignore_nan: bool = False,
    skip_null: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Apply all artifacts ``(id, year, model_key, vector, seq)`` in one left join.

    Equal to updating or adding one model column per artifact in ``seq`` order. With
    ``skip_null=False`` a newest row without vector clears the column. ``unique`` promises
    one artifact per paper and model, such as ``newest_rows`` gives: then vectors are not
    aggregated, and each model is one join on the partitioning the papers have already.
    """
    if unique:
        joined = papers
        for key in keys:
            mine = artifacts.filter(F.col("model_key") == key)
            if ignore_nan:
                mine = mine.filter(~_is_nan(F.col("vector")))
            joined = joined.join(mine.select(*on, F.col("vector").alias(f"__new_{key}"), F.lit(True).alias(f"{_HAS}{key}")), list(on), "left")
    else:
        latest = collapse(artifacts, keys, on, ignore_nan, skip_null)
        flags = [] if skip_null else [F.col(f"`{_HAS}{k}`") for k in keys]
        latest = latest.select(*on, *[F.col(f"`{k}`").alias(f"__new_{k}") for k in keys], *flags)
        joined = papers.join(latest, list(on), "left")

    def value(key: str) -> Column:
        new = F.col(f"`__new_{key}`")
        if key not in papers.columns:
            return new
        if skip_null:
            return F.coalesce(new, F.col(f"`{key}`"))
        return F.when(F.coalesce(F.col(f"`{_HAS}{key}`"), F.lit(False)), new).otherwise(F.col(f"`{key}`"))

    kept = [F.col(f"`{c}`") for c in papers.columns if c not in keys]
    return joined.select(*kept, *[value(key).alias(key) for key in keys])


def to_long(papers: DataFrame, keys: Sequence[str], on: Sequence[str] = KEYS) -> DataFrame:
    """Model columns as rows ``(id, year, model_key, vector)``, missing vectors left out."""
    entries = [
        F.struct(F.lit(key).alias("model_key"), F.col(f"`{key}`").alias("vector")) for key in keys
    ]
    rows = papers.select(*on, F.inline(F.array(*entries)))
    return rows.filter(F.col("vector").isNotNull())


def wide_view(
    papers: DataFrame,
    vectors: DataFrame,
    models: Mapping[str, ModelSpec],
    fill: str = "null",
    on: Sequence[str] = KEYS,
) -> DataFrame:
    """Papers with the newest vector of each model; an absent one is ``null`` or ``zero``."""
    metadata = papers.select(*[c for c in papers.columns if c not in models])
    wide = overlay(metadata, vectors, list(models), on, skip_null=False)
    if fill == "zero":
        wide = wide.withColumns({
            key: F.coalesce(F.col(f"`{key}`"), zero_vector(spec.dimension)) for key, spec in models.items()
        })
    return wide
