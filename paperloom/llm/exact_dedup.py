"""Exact deduplication with a keyed stream that keeps its state on disk and never expires.

The stream keeps one entry per digest: how often the text was seen, the stable
identifier of the row that stays and a locator from which its text can be read again.
Rows are combined inside each task before they are shuffled, so one text that makes up
a third of all rows costs one state update per task. A digest alone proves nothing:
every hit is compared with the kept row's text, byte for byte, and rows whose texts
differ under one digest are grouped by their text.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, drop_scratch, shared_dir

#: Rows of one digest that one task compares with the kept text.
HITS_PER_TASK = 10_000
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each of many small stores would else reserve megabytes for its logs in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_text(text: Column) -> Column:
    """Lower-case hex digest of a text's UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


@contextmanager
def _disk_state(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def digest_state(landed: str, spark: SparkSession, schema, checkpoint: str, output: str) -> None:
    """Feed what lies in ``landed`` through the keyed stream; append changed entries to ``output``.

    Calling it again with the same ``checkpoint`` takes only files that came since, on
    top of the entries kept so far. ``output`` gets one file set per micro-batch, named
    by it, so a batch that is repeated after a failure replaces its own rows. The latest
    entry of a digest is the one with the largest ``group_size``.
    """
    keyed = (
        spark.readStream.schema(schema)
        .parquet(landed)
        .groupBy("digest", "n_bytes")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"), F.max("locator").alias("locator"))
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    with _disk_state(spark):
        query = (
            keyed.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()


def latest_state(spark: SparkSession, output: str) -> DataFrame:
    """The newest entry of each digest from what the stream has appended."""
    return (
        spark.read.parquet(output)
        .groupBy("digest", "n_bytes")
        .agg(F.max(F.struct("group_size", "keep_id", "locator")).alias("entry"))
        .select("digest", "n_bytes", "entry.*")
    )


def _checked(docs: DataFrame, rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of shared digests whose text differs from the kept row's text: ``locator, digest, n_bytes``."""
    shared = state.filter("group_size > 1").withColumn("salts", F.ceil(F.col("group_size") / HITS_PER_TASK).cast("int"))
    roles = rows.join(shared.select("digest", "n_bytes", F.col("locator").alias("kept"), "salts"), ["digest", "n_bytes"])
    texts = (
        roles.join(docs.select(F.col("locator"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes")), "locator")
        .withColumn("salt", F.pmod(F.xxhash64("locator"), F.col("salts")).cast("int"))
    )
    keepers = (
        texts.filter("locator = kept")
        .select("digest", "n_bytes", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("bytes").alias("kept_bytes"))
    )
    return (
        texts.join(keepers, ["digest", "n_bytes", "salt"])
        .filter(F.col("bytes") != F.col("kept_bytes"))
        .select("locator", "digest", "n_bytes")
    )


def exact_groups(docs: DataFrame, digest: Column | None = None) -> DataFrame:
    """Group equal texts: ``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs``.

    Texts are equal when all their bytes are; null counts as the empty text, so nulls
    and empty texts form one group. The row with the largest ``doc_id`` stays; of
    repeated rows with one ``doc_id`` exactly one is kept. Rows without ``doc_id`` lose
    against others; a group of them alone has a null ``keep_id`` and keeps one row.
    An empty table gives no rows. Other columns are ignored.

    ``digest`` is the state's key, SHA-256 by default. A weaker one gives the same rows,
    since hits are compared in full.
    """
    source = docs.select("doc_id", "text")
    source = source.withColumn("__paperloom_row", F.lit(0)) if names_every_row(source) else numbered_rows(source)
    return _groups(source, digest).drop("locator")


def _groups(source: DataFrame, digest: Column | None = None) -> DataFrame:
    """``exact_groups`` of ``doc_id, text, __paperloom_row``, each row with its ``locator``."""
    spark = source.sparkSession
    key = sha256_text(F.col("text")) if digest is None else digest.cast("string")
    # The locator orders as doc_id does and is its own row's: repeated rows get different ones.
    source = source.select(
        "doc_id", "text",
        F.struct(F.col("doc_id").alias("doc_id"), F.col("__paperloom_row").alias("copy")).alias("locator"),
    )
    rows = cut_lineage(
        source.select(
            "doc_id", "locator", key.alias("digest"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
            sha256_text(F.col("text")).alias("text_sha256"),
        ),
        "digests",
    )
    landed = rows.inputFiles()[0].rsplit("/", 1)[0] if not rows.isEmpty() else None
    if landed is None:
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), "text_sha256", "locator")
    checkpoint, output = shared_dir(spark, "exact-state"), shared_dir(spark, "exact-groups")
    digest_state(landed, spark, rows.schema, checkpoint, output)
    drop_scratch(spark, checkpoint)
    state = latest_state(spark, output)
    narrow = rows.select("locator", "digest", "n_bytes")
    differing = cut_lineage(_checked(source, narrow, state), "differing")
    result = rows.join(state.withColumnRenamed("locator", "kept_locator"), ["digest", "n_bytes"])
    same = result.select(
        "doc_id", "keep_id", "group_size", (F.col("locator") == F.col("kept_locator")).alias("kept"), "text_sha256", "locator"
    )
    if differing.isEmpty():
        return same
    # A digest with more than one text: its rows are grouped by the text itself.
    clashing = differing.select("digest", "n_bytes").distinct()
    good = result.join(clashing, ["digest", "n_bytes"], "left_anti").select(
        "doc_id", "keep_id", "group_size", (F.col("locator") == F.col("kept_locator")).alias("kept"), "text_sha256", "locator"
    )
    texts = (
        rows.join(clashing, ["digest", "n_bytes"], "left_semi").select("doc_id", "locator", "text_sha256")
        .join(source.select("locator", F.coalesce("text", F.lit("")).alias("text")), "locator")
    )
    groups = texts.groupBy("text").agg(F.count(F.lit(1)).alias("group_size"), F.max("locator").alias("kept_locator"))
    split = texts.join(groups, "text").select(
        "doc_id", F.col("kept_locator.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("kept_locator")).alias("kept"), "text_sha256", "locator",
    )
    return good.unionByName(split)


def names_every_row(source: DataFrame) -> bool:
    """Whether ``doc_id`` names every row."""
    found = source.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    if found[0] != found[1]:
        return False
    return source.groupBy("doc_id").count().filter("count > 1").isEmpty()


def numbered_rows(source: DataFrame) -> DataFrame:
    """Rows with a number ``__paperloom_row`` that tells repeated and missing ids apart, fixed by writing them once."""
    return cut_lineage(source.withColumn("__paperloom_row", F.monotonically_increasing_id()), "numbered")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """One row of each text with all its columns: that with the largest ``doc_id``, one of repeated rows.

    A row without ``doc_id`` stays if its text has no row with one, and is then the only one.
    """
    if names_every_row(docs):
        kept = _groups(docs.select("doc_id", "text", F.lit(0).alias("__paperloom_row"))).filter("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(docs.columns)
    rows = numbered_rows(docs)
    kept = _groups(rows.select("doc_id", "text", "__paperloom_row")).filter("kept").select(F.col("locator.copy").alias("__paperloom_row"))
    return rows.join(kept, "__paperloom_row", "left_semi").select(docs.columns)
