"""Merging a batch of papers into the yearly table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.operators.dedup import latest, row_hash


def merge_parts(
    existing: DataFrame,
    increment: DataFrame,
    keys: Sequence[str] = ("id",),
    order: str = "updated",
    nulls: str = "last",
    tie: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A keyed table split by a batch's keys: untouched rows, touched rows, and the winners.

    Untouched rows pass straight through; only the touched rows and the batch reach the
    ranking shuffle. Untouched rows and winners together are the merged table.
    """
    ids = increment.select(*keys).distinct()
    untouched = existing.join(ids, list(keys), "left_anti")
    touched = existing.join(ids, list(keys), "left_semi")
    return untouched, touched, latest(touched.unionByName(increment), keys, order, nulls, tie)


def merge_latest(
    existing: DataFrame,
    increment: DataFrame,
    keys: Sequence[str] = ("id",),
    order: str = "updated",
    nulls: str = "last",
    tie: Sequence[str] = (),
    existing_keyed: bool = True,
) -> DataFrame:
    """One row per key of both sides: the one with the greatest ``order`` value."""
    if not existing_keyed:
        return latest(existing.unionByName(increment), keys, order, nulls, tie)
    untouched, _, winners = merge_parts(existing, increment, keys, order, nulls, tie)
    return untouched.unionByName(winners)


def change_counts(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row: inserted, updated and unchanged keys, and the net growth in rows."""
    compared = [c for c in before.columns if c in after.columns and c not in keys]

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, row_hash(df.select(*compared)).alias(name))

    both = hashed(before, "__old").join(hashed(after, "__new"), list(keys), "full_outer")
    old, new = F.col("__old"), F.col("__new")
    return both.agg(
        F.count_if(old.isNull()).alias("inserted"),
        F.count_if(old.isNotNull() & new.isNotNull() & (old != new)).alias("updated"),
        F.count_if(old == new).alias("unchanged"),
        (F.count(new) - F.count(old)).alias("net_growth"),
    )


def matched(stored: DataFrame, increment: DataFrame, keys: Sequence[str], order: str, nulls: str = "last") -> DataFrame:
    """Rows of a keyed increment whose key is stored, each with ``__wins``: whether it replaces the stored row.

    A row that says the same in the columns both sides have replaces nothing, so a
    redelivered row leaves whatever else is stored beside it, such as vectors. Otherwise
    the greater ``order`` wins, and at equal values the increment. ``nulls`` says
    whether a missing value is the least (``last``) or the greatest (``first``).
    """
    old, wins = _compared(stored, increment, keys, order, nulls)
    return increment.join(old, list(keys)).select(*[F.col(f"`{c}`") for c in increment.columns], wins.alias("__wins"))


def winning(stored: DataFrame, increment: DataFrame, keys: Sequence[str], order: str, nulls: str = "last") -> DataFrame:
    """Rows of a keyed increment that are new, or replace the stored row by the rule of ``matched``."""
    old, wins = _compared(stored, increment, keys, order, nulls)
    met = increment.join(old.withColumn("__stored", F.lit(True)), list(keys), "left")
    return met.filter(F.col("__stored").isNull() | wins).select(*[F.col(f"`{c}`") for c in increment.columns])


def _compared(stored: DataFrame, increment: DataFrame, keys: Sequence[str], order: str, nulls: str) -> tuple[DataFrame, Column]:
    """Stored rows under other names, and whether the row of the increment joined to one replaces it."""
    shared = [c for c in increment.columns if c in stored.columns and c not in keys]
    old = stored.select(*keys, *[F.col(f"`{c}`").alias(f"__old_{c}") for c in shared])
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__old_{c}`")) for c in shared], F.lit(True))
    new_value = F.col(f"`{order}`")
    old_value = F.col(f"`__old_{order}`") if order in shared else F.lit(None).cast(increment.schema[order].dataType)
    least = old_value.isNull() if nulls == "last" else new_value.isNull()
    later = least | F.coalesce(new_value >= old_value, F.lit(False))
    return old, ~same & later


def changed_rows(stored: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a keyed batch that are new, or differ from the stored row in a column of the batch.

    A column that is not stored counts as null there. A row that only repeats the stored
    one is left out, so that what is stored beside it, such as vectors the batch does not
    carry, stays.
    """
    shared = [c for c in newest.columns if c in stored.columns and c not in keys]
    added = [c for c in newest.columns if c not in stored.columns]
    old = stored.select(*keys, *[F.col(f"`{c}`").alias(f"__old_{c}") for c in shared], F.lit(True).alias("__stored"))
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__old_{c}`")) for c in shared], F.col("__stored").isNotNull())
    same = reduce(and_, [F.col(f"`{c}`").isNull() for c in added], same)
    return newest.join(old, list(keys), "left").filter(~same).select(*[F.col(f"`{c}`") for c in newest.columns])


def replaced_keys(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("id", "year")) -> DataFrame:
    """Keys of rows the merge replaced by other content."""
    compared = [c for c in before.columns if c in after.columns and c not in keys]
    old = before.select(*keys, row_hash(before.select(*compared)).alias("__old"))
    new = after.select(*keys, row_hash(after.select(*compared)).alias("__new"))
    return old.join(new, list(keys)).filter(F.col("__old") != F.col("__new")).select(*keys)
