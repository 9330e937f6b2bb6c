"""Splitting a backlog into balanced work lists.

Tasks are shuffled into the order of a seeded hash and cut into consecutive lists. The
global rank is the rank inside a hash bucket plus the number of tasks in the buckets
before it, so no task of the job sees more than one bucket. Equal tasks share a hash;
they are counted first and enter the ranking as one weighted row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Copies of one task that a single row may expand into at once.
_COPIES_PER_ROW = 10_000


def order_key(columns: list[str], seed: int = 42) -> Column:
    """Seeded hash that stands for a random order which is the same on every run."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _copies(start: Column, count: Column) -> Column:
    return F.explode(F.sequence(start, start + count - 1))


def rank_tasks(tasks: DataFrame, seed: int = 42, unique: bool = False, bucket_digits: int = 3) -> DataFrame:
    """Add ``task_rank`` (from 0, in hash order) and ``task_total``.

    ``unique`` promises distinct rows and saves the counting shuffle. There are
    16 ** bucket_digits buckets; their sizes are the only data sent to every task.
    """
    if not 1 <= bucket_digits <= 4:
        raise ValueError("bucket_digits must be 1 to 4")
    columns = tasks.columns
    if unique:
        weighted = tasks.withColumn("__copies", F.lit(1).cast("bigint"))
    else:
        weighted = tasks.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    hashed = weighted.withColumn("__order", order_key(columns, seed)).withColumn(
        "__bucket", F.substring("__order", 1, bucket_digits)
    )

    # Without ``unique`` both uses of the counted tasks read the same shuffle.
    sizes = hashed.groupBy("__bucket").agg(F.sum("__copies").alias("__size"))
    # At most 65,536 rows of two numbers from here on.
    all_buckets = Window.partitionBy(F.lit(0)).orderBy("__bucket")
    offsets = sizes.select(
        "__bucket",
        (F.sum("__size").over(all_buckets) - F.col("__size")).alias("__offset"),
        F.sum("__size").over(Window.partitionBy(F.lit(0))).alias("task_total"),
    )

    in_bucket = Window.partitionBy("__bucket").orderBy("__order", *[F.col(f"`{c}`") for c in columns])
    before = F.sum("__copies").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (
        hashed.withColumn("__start", before - F.col("__copies"))
        .join(F.broadcast(offsets), "__bucket")
        .withColumn("__start", F.col("__start") + F.col("__offset"))
    )
    output = [*[F.col(f"`{c}`") for c in columns], F.col("task_total")]
    if unique:
        return ranked.select(*output, F.col("__start").alias("task_rank"))

    few = ranked.filter(F.col("__copies") <= _COPIES_PER_ROW)
    few = few.select(*output, _copies(F.col("__start"), F.col("__copies")).alias("task_rank"))
    # A heavily repeated task is cut into chunks, and the chunks are spread over tasks.
    step = F.lit(_COPIES_PER_ROW).cast("bigint")
    end = F.col("__start") + F.col("__copies")
    many = ranked.filter(F.col("__copies") > _COPIES_PER_ROW).select(
        *output, end.alias("__end"), F.explode(F.sequence(F.col("__start"), end - 1, step)).alias("__from")
    )
    many = many.repartition("__from").select(
        *output, _copies(F.col("__from"), F.least(step, F.col("__end") - F.col("__from"))).alias("task_rank")
    )
    return few.unionByName(many)


def split_tasks(
    tasks: DataFrame,
    lists: int = 10,
    max_per_list: int | None = None,
    seed: int = 42,
    unique: bool = False,
    bucket_digits: int = 3,
) -> DataFrame:
    """Assign tasks to at most ``lists`` work lists of equal size; the last may be shorter.

    Adds ``matrix_id`` and keeps ``task_rank`` and ``task_total``. With ``max_per_list``
    the tasks beyond ``lists * max_per_list`` wait for a later run and are left out here.
    """
    if lists < 1 or (max_per_list is not None and max_per_list < 1):
        raise ValueError("lists and max_per_list must be at least 1")
    per_list = F.expr(f"(task_total + {int(lists)} - 1) div {int(lists)}")
    if max_per_list is not None:
        per_list = F.least(per_list, F.lit(max_per_list).cast("bigint"))
    ranked = rank_tasks(tasks, seed, unique, bucket_digits).withColumn("__per", per_list)
    assigned = ranked.filter(F.col("task_rank") < F.col("__per") * lists)
    return assigned.withColumn("matrix_id", F.expr("cast(task_rank div __per as int)")).drop("__per")


def split_summary(assigned: DataFrame) -> DataFrame:
    """One row: total, assigned and dropped tasks, number of lists and their ids as JSON.

    The list of ids has one entry per work list.
    """
    per_list = assigned.groupBy("matrix_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("task_total").alias("task_total")
    )
    ids = F.sort_array(F.collect_list(F.struct("matrix_id")))
    return per_list.agg(
        F.coalesce(F.max("task_total"), F.lit(0).cast("bigint")).alias("total_tasks"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("assigned_tasks"),
        (F.coalesce(F.max("task_total"), F.lit(0)) - F.coalesce(F.sum("n"), F.lit(0))).alias("dropped_tasks"),
        F.count(F.lit(1)).alias("matrix_count"),
        F.to_json(ids).alias("matrices"),
    )
