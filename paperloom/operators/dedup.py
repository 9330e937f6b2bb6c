"""One row per key: latest, first, or newest batch wins.

Every rule is ``row_number() = 1``. Spark cuts each key to one row per task before the
shuffle, so the number of copies of a key does not decide the size of any task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

_RANK = "__rank"


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns: breaks ties the same way on every run, and tells contents apart.

    Spark's hash skips nulls and flattens arrays, so null flags, array sizes and null
    elements are hashed too.
    """
    parts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        parts += [column, column.isNull()]
        if isinstance(field.dataType, ArrayType):
            parts += [F.size(column), F.transform(column, lambda x: x.isNull())]
    return F.xxhash64(*parts)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], total: bool = False) -> DataFrame:
    """Keep the first row of each key under ``order``.

    Remaining ties go by row hash, unless ``total`` promises that there are none; the
    hash reads every column, so the promise keeps unused ones out of the scan.
    """
    tail = [] if total else [row_hash(df)]
    window = Window.partitionBy(*keys).orderBy(*order, *tail)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    order: str = "updated",
    nulls: str = "last",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the greatest ``order`` value per key.

    ``nulls`` says whether a missing value loses (``last``) or wins (``first``). Equal
    values are decided by ``tie`` ascending, whose columns must tell all rows of a key
    apart; without ``tie`` they are decided by row hash.
    """
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls must be first or last, not {nulls}")
    column = F.col(order)
    placed = column.desc_nulls_last() if nulls == "last" else column.desc_nulls_first()
    return first_by(df, keys, [placed, *[F.col(t).asc() for t in tie]], total=bool(tie))


def keep_first(df: DataFrame, keys: Sequence[str] = ("id",), arrival: Sequence[str] = ("seq",)) -> DataFrame:
    """Keep the row that arrived first per key; ``arrival`` tells all rows of a key apart."""
    return first_by(df, keys, [F.col(c).asc() for c in arrival], total=bool(arrival))


def keep_last(df: DataFrame, keys: Sequence[str] = ("id",), arrival: Sequence[str] = ("seq",)) -> DataFrame:
    """Keep the row that arrived last per key; without ``arrival`` the row hash decides."""
    return first_by(df, keys, [F.col(c).desc() for c in arrival], total=bool(arrival))


def new_wins(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = ("id",),
    arrival: Sequence[str] = ("seq",),
    existing_keyed: bool = False,
) -> DataFrame:
    """Union of both sides with one row per key: new before existing, later before earlier.

    ``existing_keyed`` promises that the existing side already has unique keys. It is
    then only filtered by the new keys and, for a small batch, never shuffled.
    """
    if existing_keyed:
        return without_keys(existing, new, keys).unionByName(keep_last(new, keys, arrival))
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    order = [F.col(c).desc() for c in ["__new", *arrival]]
    return first_by(both, keys, order, total=bool(arrival)).drop("__new")


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")
