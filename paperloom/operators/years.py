"""Year assignment and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.dates import DATE_FORMAT, TIMESTAMP_FORMAT, year_of

BOTH_FORMATS = (TIMESTAMP_FORMAT, DATE_FORMAT)


def with_year(df: DataFrame, rule: str | int = "created", formats: tuple[str, ...] = (TIMESTAMP_FORMAT,)) -> DataFrame:
    """Add ``year``: from a date column named by ``rule``, or one fixed year for a batch.

    A fixed year is the harvested year, or the calendar year of an incremental run.
    """
    year = F.lit(rule) if isinstance(rule, int) else year_of(rule, formats)
    return df.withColumn("year", year.cast("int"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a year, and rows without one (to be quarantined)."""
    return df.filter(F.col("year").isNotNull()), df.filter(F.col("year").isNull()).drop("year")


def select_years(df: DataFrame, years: str = "", exact: bool = False, column: str = "year") -> DataFrame:
    """Rows of the requested years, given as a comma list; an empty list selects all.

    The default matches parts of the year, so ``202`` covers 2020 to 2029. ``exact``
    compares whole years. Both prune partitions of a yearly table.
    """
    if not years:
        return df
    wanted = [y.strip() for y in years.split(",")]
    if exact:
        return df.filter(F.col(column).isin([int(y) for y in wanted]))
    text = F.col(column).cast("string")
    hit: Column = F.lit(False)
    for part in wanted:
        hit = hit | F.contains(text, F.lit(part))
    return df.filter(hit)


def distinct_years(df: DataFrame, column: str = "year") -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def touched_years(df: DataFrame, column: str = "year") -> list[int]:
    """The years a batch touches, as literals for static partition pruning.

    Bounded by the number of calendar years in the table, not by its rows.
    """
    return [row[0] for row in df.select(column).distinct().collect() if row[0] is not None]
