"""The keyed stream of real changes, alone and in front of the table."""

import random

import pytest
from paperloom.sources.tables import read_years
from paperloom.streaming import changed_versions, disk_state, ingest_pages, stream_table
from paperloom.streaming.latest import newer
from paperloom.versions import create_table, live_parts, snapshot
from test_sources import _page, _record

SCHEMA = "id string, updated string, title string, tags array<string>, n int"


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _drain(spark, landed, output, state, **options):
    stream = stream_table(spark, landed, spark.createDataFrame([], SCHEMA).schema, max_files=1)
    with disk_state(spark):
        changes = changed_versions(stream, content=["title", "tags", "updated"], **options)
        sink = changes.writeStream.format("parquet").option("path", output).option("checkpointLocation", state)
        sink.trigger(availableNow=True).start().awaitTermination()
    return sorted(
        (tuple(r) for r in spark.read.schema(SCHEMA).parquet(output).collect()), key=str
    )


@pytest.mark.parametrize("shards", [1, 3])
def test_only_real_changes_pass(spark, folder, shards):
    landed, output, state = folder("landed"), folder("out"), folder("state")
    known = spark.createDataFrame([("k", "2024-01-01", "x", ["q", None], 7), ("m", None, "x", None, 7)], SCHEMA)
    first = [("a", "2024-01-01", "x", ["p", None], 1), ("a", "2024-01-02", "y", [], 2), ("b", None, "z", None, 3)]
    first += [("k", "2024-01-01", "x", ["q", None], 9), (None, "2024-01-01", "broken", None, 1), (None, "2024-01-01", "broken", None, 1)]
    _land(spark, landed, first * 3)
    passed = [("a", "2024-01-02", "y", [], 2), ("b", None, "z", None, 3)] + [first[-1]] * 6
    assert _drain(spark, landed, output, state, known=known, shards=shards) == sorted(passed, key=str)
    # Redelivered, late, and repeated with another column that is not compared; then changes.
    _land(spark, landed, [*first[:4], ("a", "2023-01-01", "late", [], 5), ("a", "2024-01-02", "y", [], 77), ("m", None, "x", None, 1)])
    assert _drain(spark, landed, output, state, known=known, shards=shards) == sorted(passed, key=str)
    changed = [("b", "2020-01-01", "z", None, 3), ("a", "2024-01-02", "other", [], 2), ("k", "2024-02-01", "x", ["q", None], 9), ("m", None, "x", [], 1)]
    _land(spark, landed, changed)
    assert _drain(spark, landed, output, state, known=known, shards=shards) == sorted(passed + changed, key=str)


def test_replayed_batches_end_in_the_newest_versions(spark, folder):
    landed, output = folder("landed"), folder("out")
    draw = random.Random(5)
    rows = [(f"p{draw.randrange(12)}", draw.choice([None, "2024-01-01", "2024-01-02", "2024-01-03"]), f"t{draw.randrange(3)}", None, 0) for _ in range(120)]
    for k in range(0, 120, 40):
        _land(spark, landed, rows[k : k + 40])
    told = _drain(spark, landed, output, folder("state"))
    again = folder("again")
    assert sorted({(r[0], max(x[1] or "" for x in rows if x[0] == r[0])) for r in rows}) == sorted(
        {(i, max(r[1] or "" for r in told if r[0] == i)) for i in {r[0] for r in told}}
    )
    assert {r[0]: r for r in _drain(spark, landed, again, folder("other"))}.keys() == {r[0] for r in rows}


def test_order_of_versions():
    assert newer(None, 1, None) and newer("2024", 2, (None, 1)) and newer("2024", 2, ("2024", 1)) and newer(None, 2, (None, 1))
    assert not newer("2024", 1, ("2023", 1)) and not newer("2023", 2, ("2024", 1)) and not newer(None, 2, ("2024", 1))


def test_pages_to_table_touch_only_what_changes(spark, folder):
    landed, root, state, bad = folder("pages"), folder("table"), folder("state"), folder("bad")
    create_table(spark, root, spark.createDataFrame([], "id string, year int").schema, buckets=8)

    def run():
        ingest_pages(spark, landed, root, state, bad, rule=2024, keep="latest", max_files=1).awaitTermination()
        return live_parts(spark, root, snapshot(spark, root))

    _page(landed, "1.xml", *[_record(f"p{k}") for k in range(30)])
    first = run()
    assert read_years(spark, root).count() == 30
    _page(landed, "2.xml", *[_record(f"p{k}") for k in range(30)], "<record><header></metadata></record>")
    assert run() == first
    _page(landed, "3.xml", *[_record(f"p{k}") for k in range(29)], _record("p29", updated="<updated>2024-02-01</updated>", title="new"))
    second = run()
    assert len({p for p in second if second[p] != first.get(p)}) == 1
    assert {r.title for r in read_years(spark, root).filter("id = 'p29'").collect()} == {"new"} and read_years(spark, root).count() == 30
    assert spark.read.parquet(f"{bad}-corrupt").count() >= 1
