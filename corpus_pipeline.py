"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Every stage works on all rows its predecessor kept. All but the last return the columns
of ``documents``; the last returns the mixture's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.decontaminate import drop_leaks
from paperloom.llm.exact_dedup import drop_exact_copies
from paperloom.llm.language_id import keep_identified
from paperloom.llm.mixing import mix_sources
from paperloom.llm.near_dedup import keep_one_of_each
from paperloom.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mixture of sources."""
    return mix_sources(docs, max_repeats=1.25)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", leaks),
    ("mix_sources", mixture),
]

#: The language classifier and the near-duplicate groups have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
