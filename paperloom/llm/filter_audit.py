"""How five filters act together: the Hart-Mas-Colell potential of the removal game.

A coalition is a set of filters; its worth is how many documents fail at least one of
them. Documents are counted once by part and by the set of filters they fail, which is
all that any order of filters depends on: 32 worths a part follow from these counts.
The potential of a coalition is its worth plus the potentials of all coalitions with one
filter less, divided by its size, and a filter's Shapley value is the grand potential
less the potential without that filter. Steps of an order are differences of worths.

Everything is DataFrame expressions. Texts are read once; what is shuffled is one narrow
row a document, and equal texts are combined inside tasks before they meet.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.exact_dedup import sha256_text
from paperloom.session import cut_lineage

FILTERS = "ABCDE"
GRAND = (1 << len(FILTERS)) - 1
#: Least words, least percentage of distinct words, greatest percentage of capitals, forbidden characters.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, FORBIDDEN = 50, 65, 5, "[#$%&*|]"
#: Potentials are kept as whole multiples of 1/60: 60 divides by every coalition size.
_UNIT = 60
_COUNTS = ("n", "good", "toxic")


def failed_in_text(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = [
        n_words < MIN_WORDS,
        F.lit(100) * n_distinct.cast("long") < F.lit(MIN_DISTINCT) * n_words.cast("long"),
        F.lit(100) * capitals.cast("long") > F.lit(MAX_CAPITALS) * F.length(text).cast("long"),
        text.rlike(FORBIDDEN),
    ]
    return sum((t.cast("int") * F.lit(1 << k) for k, t in enumerate(tests)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by ``part`` and ``mask``, the bits of all filters they fail: ``n, good, toxic``.

    A row fails E if a smaller ``doc_id`` has the same text anywhere in the table. Texts
    are the same when length and SHA-256 are. Rows without ``doc_id`` have no smaller or
    larger id and no labels. Rows of one id and text count each, and do not fail E for
    each other. Of several labels of one id the greatest counts.
    """
    rows = cut_lineage(
        docs.select(
            "doc_id",
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            F.concat(F.coalesce(F.octet_length("text"), F.lit(0)).cast("string"), F.lit(":"), sha256_text(F.col("text"))).alias("same"),
            failed_in_text(F.col("text")).alias("mask"),
        ),
        "filter-masks",
    )
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    known = rows.filter("doc_id is not null").join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    # One row for each id and text, dealt by id; then one for each text, part and label, combined in tasks.
    kinds = ["same", "part", "mask", "good", "toxic"]
    ids = known.groupBy("doc_id", *kinds).agg(F.count(F.lit(1)).alias("copies"))
    texts = ids.groupBy(*kinds).agg(F.min(F.struct("doc_id", "copies")).alias("first"), F.sum("copies").alias("n"))
    # The smallest id of a text: again combined in tasks, and joined to rows that are few for any text.
    least = ids.groupBy("same").agg(F.min("doc_id").alias("least"))
    met = texts.join(least, "same")
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.copies")).otherwise(F.lit(0))
    split = met.select("part", "mask", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("again"), firsts.alias("n")),
        F.struct(F.lit(1 << 4).alias("again"), (F.col("n") - firsts).alias("n")),
    )).alias("kind"))
    counted = split.select(
        "part", (F.col("mask") + F.col("kind.again")).alias("mask"), F.col("kind.n").alias("n"),
        (F.col("kind.n") * F.col("good")).alias("good"), (F.col("kind.n") * F.col("toxic")).alias("toxic"),
    )
    unnamed = rows.filter("doc_id is null").select(
        "part", "mask", F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")
    )
    return counted.unionByName(unnamed).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def coalition_worths(counts: DataFrame) -> DataFrame:
    """For each part arrays of 32 worths by coalition: ``n, good, toxic``, the part's ``total`` and ``alone``.

    ``alone`` has for each filter the documents that fail no other.
    """
    def worth(name: str) -> Column:
        return F.array(*[
            F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(name))), F.lit(0).cast("long")) for s in range(GRAND + 1)
        ]).alias(name)

    alone = F.array(*[
        F.coalesce(F.sum(F.when(F.col("mask") == 1 << k, F.col("n"))), F.lit(0).cast("long")) for k in range(len(FILTERS))
    ])
    return counts.groupBy("part").agg(*[worth(c) for c in _COUNTS], F.sum("n").alias("total"), alone.alias("alone"))


def with_potentials(worths: DataFrame) -> DataFrame:
    """Adds ``potential``: the potential of every coalition in units of 1/60, exact whole numbers.

    Coalitions are numbered by their filters' bits, so all those with one filter less come
    earlier in the array that grows as the recursion goes.
    """
    without = F.array(*[
        F.array(*[F.lit(s & ~(1 << k)) for k in range(len(FILTERS)) if s >> k & 1] or [F.lit(0)]) for s in range(GRAND + 1)
    ])

    def grow(done: Column, s: Column) -> Column:
        smaller = F.element_at(without, s + 1)
        total = F.aggregate(smaller, F.element_at("n", s + 1) * F.lit(_UNIT), lambda a, t: a + F.element_at(done, t + 1))
        return F.concat(done, F.array((total / F.size(smaller)).cast("long")))

    start = F.array(F.lit(0).cast("long"))
    return worths.withColumn("potential", F.aggregate(F.sequence(F.lit(1), F.lit(GRAND)), start, grow))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every step of every order of the filters A to E, for each part of ``docs``.

    Returns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``. ``part`` is ``source``, null as the empty string; ``shapley`` is
    the filter's removed documents summed over all 120 orders. Null texts count as empty;
    an empty table has no parts and gives no rows. Other columns are ignored.
    """
    game = with_potentials(coalition_worths(failure_counts(docs, labels)))
    orders = ",".join(f"'{''.join(o)}'" for o in permutations(FILTERS))
    steps = len(FILTERS)
    rows = (
        game.withColumn("at", F.explode(F.expr(f"sequence(0, {factorial(steps) * steps - 1})")))
        .withColumn("filter_order", F.expr(f"array({orders})[at div {steps}]"))
        .withColumn("step", F.expr(f"at % {steps} + 1"))
        .withColumn("k", F.expr(f"instr('{FILTERS}', substr(filter_order, step, 1)) - 1"))
        .withColumn("before", F.expr(f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (s, f) -> s + shiftleft(1, instr('{FILTERS}', f) - 1))"))
    )
    bit = F.expr("shiftleft(1, k)")
    after = F.col("before") + bit

    def gained(name: str) -> Column:
        return F.element_at(name, after + 1) - F.element_at(name, F.col("before") + 1)

    own = F.element_at("n", bit + 1)  # documents that fail this filter
    shapley = (F.element_at("potential", GRAND + 1) - F.element_at("potential", F.lit(GRAND) - bit + 1)) * F.lit(factorial(steps) // _UNIT)
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.element_at("n", after + 1)).alias("kept"),
        gained("n").alias("removed"),
        (own - gained("n")).alias("redundant"),
        F.element_at("alone", F.col("k") + 1).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
