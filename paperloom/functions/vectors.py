"""Vector state, repair and alignment expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from paperloom.functions.text import _col

# Fixed values.
NEAR_ZERO = 1e-7
PREVIEW_LENGTH = 5


def newest_first(seq: Column | str, absent: Column, *tie: Column) -> Column:
    """What the newest row of a (paper, model) is the greatest of: its ``seq``, and at equal ``seq`` a row without vector wins."""
    return F.struct(_col(seq).alias("seq"), absent.alias("absent"), *[t.alias(f"tie{k}") for k, t in enumerate(tie)])


def vector_sum(v: Column | str) -> Column:
    """Sum of the elements in double precision; null elements are skipped, null stays null."""
    return F.aggregate(_col(v), F.lit(0.0), lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0)))


def near_zero_sum(total: Column | str) -> Column:
    """Whether a vector sum counts as zero. Null and NaN do not."""
    return F.coalesce(F.abs(_col(total)) < NEAR_ZERO, F.lit(False))


def is_near_zero(v: Column | str) -> Column:
    return near_zero_sum(vector_sum(v))


def needs_vector_sum(total: Column | str, retry_nan: bool = False) -> Column:
    """Backlog predicate on a stored sum: missing or near zero, with ``retry_nan`` also NaN."""
    missing = _col(total).isNull() | near_zero_sum(total)
    return missing | F.coalesce(F.isnan(_col(total)), F.lit(False)) if retry_nan else missing


def needs_vector(v: Column | str, retry_nan: bool = False) -> Column:
    return needs_vector_sum(vector_sum(v), retry_nan)


def any_nonzero(keys: list[str]) -> Column:
    """Whether at least one of several model columns holds a non-zero sum (NaN counts)."""
    return reduce(lambda a, b: a | b, [vector_sum(k) != 0 for k in keys])


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def nan_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(float("nan")).cast("float"), dim)


def repair(v: Column | str, dim: int) -> Column:
    """The vector if it has the registered length, else an all-NaN one."""
    return F.when(F.size(_col(v)) == dim, _col(v)).otherwise(nan_vector(dim))


def cast_vector(v: Column | str, dim: int | None = None) -> Column:
    """As ``array<float>``; with ``dim``, a non-null vector of another length is an error."""
    cast = _col(v).cast("array<float>")
    if dim is None:
        return cast
    wrong = cast.isNotNull() & (F.size(cast) != dim)
    return F.when(wrong, F.raise_error(F.lit(f"vector length is not {dim}"))).otherwise(cast)


def preview(v: Column | str) -> Column:
    return F.slice(_col(v), 1, PREVIEW_LENGTH)
