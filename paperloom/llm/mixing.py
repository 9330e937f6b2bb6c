"""Mixing sources: tempered token shares, and budgets filled by blocks of a permutation.

A source's weight is its token share to the power ``alpha``, normalised. ``alpha = 1``
keeps the natural mix and ``alpha = 0`` makes all sources equal. The exponent is
bisected: the smallest one under which no source is repeated more than ``max_repeats``
times, or the one whose weights have the entropy asked for. Each source then gets its
share of the token budget: whole passes over it, and for the rest a prefix of a keyed
permutation, filled block by block.

Words are counted once and written, with ids, to the shared folder. A source that holds a third of all rows is spread over
hash blocks: only the sums of blocks are accumulated in order, and rows only inside one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

#: Sources whose shares the driver may hold while it bisects.
MAX_SOURCES = 100_000
#: About so many rows share a block of the permutation.
BLOCK_ROWS = 1_000


def word_count(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def tempered(shares: list[float], alpha: float) -> list[float]:
    """Shares to the power ``alpha``, normalised; a share of 0 stays 0."""
    raised = [s**alpha if s > 0 else 0.0 for s in shares]
    total = sum(raised)
    return [r / total for r in raised] if total else raised


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect_alpha(
    tokens: list[int], budget: float, max_repeats: float | None = None, target_entropy: float | None = None, steps: int = 60
) -> float:
    """The exponent in [0, 1] that meets the target.

    Repeats and entropy both fall as the exponent grows. With a repetition limit, the
    smallest exponent that keeps it; with a target entropy, the exponent where it is
    met, or the nearer end if it lies outside. If even 1 breaks the limit, 1 is returned.
    """
    total = sum(tokens)
    if not total:
        return 1.0
    shares = [t / total for t in tokens]

    def too_flat(alpha: float) -> bool:
        weights = tempered(shares, alpha)
        if max_repeats is not None:
            return max(budget * w / t for w, t in zip(weights, tokens, strict=True) if t) > max_repeats
        return entropy(weights) > target_entropy

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def mix_sources(
    docs: DataFrame, budget: int | None = None, max_repeats: float | None = 2.0, target_entropy: float | None = None, seed: int = 7
) -> DataFrame:
    """Rows of the mixture: ``doc_id, source, n_tokens, copy, block, weight``.

    ``budget`` is in words, by default the words of ``docs``. ``copy`` counts a row's
    passes from 0. In the last, partial pass a row is in if the words before it in the
    source's permutation are fewer than what is left, so a source exceeds its budget by
    less than one row. Rows without words cost nothing and come with every whole pass.
    A null source is a source. Rows with equal id and text follow each other in the
    permutation. An empty table gives no rows.
    """
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens")), "word-counts")
    totals = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    table = totals.limit(MAX_SOURCES + 1).collect()
    if len(table) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    table = sorted(table, key=lambda r: (r["source"] is not None, r["source"] or ""))
    tokens = [r["tokens"] for r in table]
    budget = sum(tokens) if budget is None else budget
    alpha = bisect_alpha(tokens, budget, max_repeats if target_entropy is None else None, target_entropy)
    weights = tempered([t / sum(tokens) for t in tokens], alpha) if sum(tokens) else [0.0] * len(tokens)
    plan = []
    for row, weight in zip(table, weights, strict=True):
        want = int(weight * budget + 0.5)
        passes, rest = divmod(want, row["tokens"]) if row["tokens"] else (1, 0)
        plan.append((row["source"], weight, passes, rest, max(1, row["rows"] // BLOCK_ROWS)))
    shares = docs.sparkSession.createDataFrame(plan, "_source string, weight double, passes long, rest long, blocks long")
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"))
    planned = (
        rows.join(F.broadcast(shares), F.col("source").cast("string").eqNullSafe(F.col("_source")))  # at most MAX_SOURCES rows
        .withColumn("_order", order)
        .withColumn("block", F.pmod("_order", F.col("blocks")))
    )
    sums = planned.groupBy("_source", "block").agg(F.sum("n_tokens").alias("_sum"))
    # Offsets of blocks in two steps, so that a source of very many blocks is not one task's either.
    super_block = F.floor(F.col("block") / 1024)
    coarse = sums.groupBy("_source", super_block.alias("_super")).agg(F.sum("_sum").alias("_coarse"))
    coarse = coarse.withColumn(
        "_before_super", F.coalesce(F.sum("_coarse").over(Window.partitionBy("_source").orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_coarse").withColumnRenamed("_source", "_s2")
    sums = sums.withColumn("_super", super_block).withColumn(
        "_inside", F.coalesce(F.sum("_sum").over(Window.partitionBy("_source", "_super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    offsets = sums.join(coarse, F.col("_source").eqNullSafe(F.col("_s2")) & (sums["_super"] == coarse["_super"])).select(
        F.col("_source").alias("_s3"), F.col("block").alias("_b3"), (F.col("_before_super") + F.col("_inside")).alias("_before_block")
    )
    inside = Window.partitionBy("_source", "block").orderBy("_order", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = planned.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        offsets, F.col("_source").eqNullSafe(F.col("_s3")) & (F.col("block") == F.col("_b3"))
    )
    copies = F.col("passes") + (F.col("_before_block") + F.col("_inside") < F.col("rest")).cast("long")
    return (
        placed.withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
        .select("doc_id", "source", "n_tokens", "copy", "block", "weight")
    )
