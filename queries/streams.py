"""Streams over landed files, driven until no file is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.session import shared_dir
from paperloom.sources.tables import read_years
from paperloom.streaming import changed_versions, disk_state, drop_redelivered, ingest_pages, stream_oai, stream_table, upsert_stream
from paperloom.versions import create_table
from queries import query
from queries.derived import papers, table, with_papers
from queries.harvest import SQL_PAPER, flat
from queries.landing import land_pages


def _drain(stream, output: str, checkpoint: str) -> None:
    query_ = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()


@query("st1_stream_ingest", with_papers(f"select {SQL_PAPER} from papers where source <> 'src3'"))
def st1_stream_ingest(spark, sf_dir):
    output = shared_dir(spark, "q-ingested")
    pages = land_pages(spark, sf_dir, trailers=False)
    _drain(stream_oai(spark, pages), output, shared_dir(spark, "q-ingest-state"))
    return flat(spark.read.parquet(output))


@query(
    "st2_stream_upsert",
    with_papers(
        "select id, 2024 as year, title, updated from (select *, row_number() over "
        "(partition by id order by updated desc nulls last) as rn from papers) where rn = 1"
    ),
)
def st2_stream_upsert(spark, sf_dir):
    """Papers arrive in four files and two micro-batches; the end state equals one batch."""
    landed, root = shared_dir(spark, "q-batches"), shared_dir(spark, "q-upserted")
    rows = papers(spark, sf_dir).select("id", "title", "updated", "created")
    rows.repartition(4).write.parquet(landed)
    stream = stream_table(spark, landed, rows.schema, max_files=2)
    upsert_stream(stream, root, shared_dir(spark, "q-upsert-state"), rule=2024, keep="latest").awaitTermination()
    return read_years(spark, root).select("id", "year", "title", "updated")


@query(
    "st2_changed_versions",
    with_papers("select id, max(updated) as updated, 1 as told from papers group by id"),
)
def st2_changed_versions(spark, sf_dir):
    """Every paper is delivered twice: keyed state lets its newest version pass once."""
    landed, output, state = (shared_dir(spark, f"q-{name}") for name in ("versions", "told", "told-state"))
    rows = papers(spark, sf_dir).select("id", "title", "updated", "created")
    for _ in range(2):
        rows.write.mode("append").parquet(landed)
        with disk_state(spark):
            _drain(changed_versions(stream_table(spark, landed, rows.schema)), output, state)
    told = spark.read.parquet(output).groupBy("id").agg(F.max("updated").alias("updated"), F.count(F.lit(1)).cast("int").alias("told"))
    return told


@query(
    "st_ingest_pages",
    with_papers(
        "select id, 2024 as year, max(updated) as updated from papers where source <> 'src3' group by id"
    ),
)
def st_ingest_pages(spark, sf_dir):
    """The whole stream: pages, cut to real changes by keyed state, upserted into a versioned table."""
    root, pages = shared_dir(spark, "q-ingest-table"), land_pages(spark, sf_dir, trailers=False)
    create_table(spark, root, spark.createDataFrame([], "id string, year int").schema, 8)
    checkpoint, quarantine = shared_dir(spark, "q-ingest-checkpoint"), shared_dir(spark, "q-ingest-quarantine")
    ingest_pages(spark, pages, root, checkpoint, quarantine, rule=2024, keep="latest").awaitTermination()
    return read_years(spark, root).select("id", "year", "updated")


@query(
    "st_chain",
    with_papers(
        "select id, 2024 as year, max(updated) as updated from papers where source <> 'src3' group by id"
    ),
)
def st_chain(spark, sf_dir):
    """Pages as a stream, redelivered records dropped within a watermark, then the upsert."""
    root, pages = shared_dir(spark, "q-chain-table"), land_pages(spark, sf_dir, trailers=False)
    records = stream_oai(spark, pages).filter("not corrupt").drop("corrupt", "raw")
    distinct = drop_redelivered(records, "datestamp", ("id", "updated", "created"), "4000 days").drop("datestamp")
    upsert_stream(distinct, root, shared_dir(spark, "q-chain-state"), rule=2024, keep="latest").awaitTermination()
    return read_years(spark, root).select("id", "year", "updated")


@query("st3_stream_dedup", "select event_id, user_id, event_type from events")
def st3_stream_dedup(spark, sf_dir):
    """All events are delivered twice."""
    landed, output = shared_dir(spark, "q-delivered"), shared_dir(spark, "q-distinct")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.unionByName(events).write.parquet(landed)
    stream = drop_redelivered(stream_table(spark, landed, events.schema), "ts", ("event_id", "ts"))
    _drain(stream, output, shared_dir(spark, "q-distinct-state"))
    return spark.read.parquet(output).select("event_id", "user_id", "event_type")
