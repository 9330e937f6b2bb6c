"""Landed pages as a stream, redelivery filter, and micro-batch upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from paperloom.functions.dates import TIMESTAMP_FORMAT
from paperloom.plans.merge import merge_increment, upsert_years
from paperloom.schema import ModelSpec
from paperloom.sources.oai import RECORD_SCHEMA, normalize_oai
from paperloom.streaming.latest import changed_versions, disk_state


def stream_oai(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Papers of harvest pages as they land in ``path``, with ``datestamp`` as event time.

    A record that is not well formed, or the end of a page that breaks off, comes as a row
    with ``corrupt`` set and its text in ``raw``, so that no record is lost unseen:
    ``upsert_stream`` sets such rows aside, other readers filter on ``corrupt``.
    """
    reader = spark.readStream.format("xml").option("rowTag", "record").schema(RECORD_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = F.col("_corrupt_record").alias("raw")
    stamp = F.try_to_timestamp("header.datestamp").alias("datestamp")
    papers = normalize_oai(reader.load(path), stamp, raw.isNotNull().alias("corrupt"), raw, only_valid=False)
    return papers.filter(F.col("id").isNotNull() | F.col("corrupt"))


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Rows of Parquet batches as they land in ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def drop_redelivered(
    stream: DataFrame, event_time: str, keys: Sequence[str] = ("id", "updated"), delay: str = "2 days"
) -> DataFrame:
    """Drop repeats of a record that overlapping request windows deliver again.

    State is kept for ``delay``; a repeat that comes later passes, and the keyed upsert
    behind it absorbs it.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def upsert_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    arrival: Sequence[str] = (),
    rule: str | int = "created",
    formats: tuple[str, ...] = (TIMESTAMP_FORMAT,),
    quarantine: str | None = None,
    keep: str = "new",
    vectors_root: str | None = None,
    models: Mapping[str, ModelSpec] | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into the yearly table and stop when no file is left.

    ``keep="new"`` lets the batch win; ``keep="latest"`` keeps the row with the later
    ``updated`` and needs a fixed year as ``rule``. Both are keyed, and rows set aside
    lie in a folder per batch, so a batch that is replayed after a failure changes nothing.
    Rows that ``stream_oai`` marks as corrupt go to ``<quarantine>-corrupt``; without
    ``quarantine`` they end the stream with an error. With ``vectors_root``, papers whose
    content changes lose their vectors of ``models`` there.
    """
    if keep not in ("new", "latest"):
        raise ValueError(f"keep must be new or latest, not {keep}")
    if keep == "latest" and not isinstance(rule, int):
        raise ValueError("keep=latest merges into one given year")

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if "corrupt" in batch.columns:
            broken = batch.filter("corrupt").select("raw")
            if quarantine:
                broken.write.mode("overwrite").parquet(f"{quarantine}-corrupt/batch_id={batch_id}")
            elif not broken.isEmpty():
                raise RuntimeError("malformed records landed and there is no quarantine for them")
            batch = batch.filter("not corrupt").drop("corrupt", "raw", "datestamp")
        if keep == "latest":
            merge_increment(session, batch, root, rule, vectors_root=vectors_root, models=models)
        else:
            aside = f"{quarantine}/batch_id={batch_id}" if quarantine else None
            upsert_years(
                session, batch, root, aside, "overwrite", rule, formats, arrival, models, vectors_root=vectors_root
            )

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_pages(
    spark: SparkSession,
    landed: str,
    root: str,
    checkpoint: str,
    quarantine: str,
    rule: str | int = "created",
    formats: tuple[str, ...] = (TIMESTAMP_FORMAT,),
    keep: str = "new",
    max_files: int | None = None,
    shards: int = 1,
    vectors_root: str | None = None,
    models: Mapping[str, ModelSpec] | None = None,
) -> StreamingQuery:
    """Harvest pages as they land, cut to real changes, upserted into the yearly table.

    Redelivered and late versions are dropped by keyed state on disk, so a micro-batch
    touches only years, or parts of a versioned table, whose papers really change.
    """
    pages = stream_oai(spark, landed, max_files)
    content = [c for c in pages.columns if c not in ("datestamp", "raw", "corrupt")]
    with disk_state(spark):
        changes = changed_versions(pages, content=content, shards=shards)
        return upsert_stream(
            changes, root, checkpoint, rule=rule, formats=formats, quarantine=quarantine, keep=keep, vectors_root=vectors_root, models=models
        )
