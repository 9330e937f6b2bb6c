"""Streams end in the same state as one batch."""

import pytest
from paperloom.sources.tables import read_years
from paperloom.streaming import drop_redelivered, stream_oai, stream_table, upsert_stream
from pyspark.sql import functions as F
from test_sources import _page, _record

SCHEMA = "id string, created string, updated string, title string, n int"


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _state(spark, root):
    return sorted(tuple(r) for r in read_years(spark, root).select("id", "year", "title").collect())


def test_later_batches_win_and_replays_change_nothing(spark, folder):
    landed, root, state = folder("landed"), folder("table"), folder("state")
    schema = spark.createDataFrame([], SCHEMA).schema
    bad = folder("bad")

    def run(checkpoint):
        stream = stream_table(spark, landed, schema)
        upsert_stream(stream, root, checkpoint, ("n",), quarantine=bad).awaitTermination()

    day = "2024-01-01T00:00:00Z"
    _land(spark, landed, [("a", day, None, "one", 1), ("a", day, None, "two", 2), ("b", day, None, "one", 3)])
    run(state)
    assert _state(spark, root) == [("a", 2024, "two"), ("b", 2024, "one")]
    _land(spark, landed, [("a", day, None, "three", 4), ("c", "bad", None, "one", 5)])
    run(state)
    assert _state(spark, root) == [("a", 2024, "three"), ("b", 2024, "one")]
    run(state)
    assert [tuple(r) for r in spark.read.parquet(bad).select("id", "batch_id").collect()] == [("c", 1)]
    run(folder("fresh-state"))
    assert _state(spark, root) == [("a", 2024, "three"), ("b", 2024, "one")]


def test_latest_mode_ignores_the_order_of_batches(spark, folder):
    landed, root = folder("landed"), folder("table")
    schema = spark.createDataFrame([], SCHEMA).schema
    for k, day in enumerate(["2024-03-01", "2024-01-01", None, "2024-02-01"]):
        _land(spark, landed, [("a", "x", day, f"t{k}", k)])
    stream = stream_table(spark, landed, schema, max_files=1)
    upsert_stream(stream, root, folder("state"), rule=2024, keep="latest").awaitTermination()
    assert _state(spark, root) == [("a", 2024, "t0")]
    with pytest.raises(ValueError):
        upsert_stream(stream, root, folder("s"), keep="latest")


def test_pages_as_a_stream(spark, folder):
    path, output, state = folder("pages"), folder("out"), folder("state")

    def drain():
        sink = stream_oai(spark, path, max_files=1).writeStream.option("path", output).option("checkpointLocation", state)
        sink.format("parquet").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.id for r in spark.read.parquet(output).collect())

    _page(path, "1.xml", _record("a"), _record("b"))
    assert drain() == ["a", "b"]
    _page(path, "2.xml", _record("c"))
    assert drain() == ["a", "b", "c"]


def test_malformed_pages_are_set_aside(spark, folder):
    path, root, bad = folder("pages"), folder("table"), folder("bad")
    _page(path, "1.xml", _record("a"), "<record><header></metadata></record>")
    upsert_stream(stream_oai(spark, path), root, folder("s1"), rule=2024, quarantine=bad).awaitTermination()
    assert [r.id for r in read_years(spark, root).collect()] == ["a"] and "corrupt" not in read_years(spark, root).columns
    assert spark.read.parquet(f"{bad}-corrupt").count() >= 1
    with pytest.raises(Exception, match="no quarantine"):
        upsert_stream(stream_oai(spark, path), root, folder("s2"), rule=2024).awaitTermination()


def test_redelivered_records_are_dropped(spark, folder):
    landed, output = folder("landed"), folder("out")
    rows = [("a", "2024-01-01"), ("b", "2024-01-01"), ("a", "2024-01-01"), ("a", "2024-01-02")]
    df = spark.createDataFrame(rows, "id string, updated string").withColumn("seen", F.to_timestamp("updated"))
    df.write.parquet(landed)
    distinct = drop_redelivered(stream_table(spark, landed, df.schema), "seen")
    sink = distinct.writeStream.format("parquet").option("path", output).option("checkpointLocation", folder("state"))
    sink.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(output).count() == 3
