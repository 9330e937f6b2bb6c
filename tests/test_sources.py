"""Hand-made harvest pages, feeds, artifacts and task files."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from paperloom.plans.harvest import landed_records, parse_feeds, parse_pages, require_complete
from paperloom.sources.oai import normalize_oai, read_envelope, read_oai
from paperloom.sources.rss import normalize_rss, read_rss, valid_items
from paperloom.sources.tables import is_table, read_artifacts, read_task_array, read_years
from pyspark.sql import functions as F

ENVELOPE = """<?xml version="1.0" encoding="UTF-8"?>
<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">
 <responseDate>2024-01-03T00:00:00Z</responseDate>
 {body}
</OAI-PMH>
"""
RECORD = """<record><header><identifier>oai:{id}</identifier><datestamp>{stamp}</datestamp></header>
<metadata><arXiv xmlns="http://example.org/meta/"><id>{id}</id><created>2024-01-01</created>{updated}
<authors>{authors}</authors><title>{title}</title><categories>cs.AI stat.ML</categories>
<license>http://license</license><abstract>  one
two  </abstract></arXiv></metadata></record>"""
AUTHOR = "<author><keyname>{}</keyname><forenames>{}</forenames></author>"
DELETED = '<record><header status="deleted"><identifier>oai:gone</identifier></header></record>'
NO_ID = "<record><header><identifier>oai:noid</identifier></header><metadata><arXiv><title>t</title></arXiv></metadata></record>"


def _record(paper_id, stamp="2024-01-02", updated="", authors=AUTHOR.format("Doe", "Jane"), title="A &amp; B"):
    return RECORD.format(id=paper_id, stamp=stamp, updated=updated, authors=authors, title=title)


def _page(folder, name, *records, trailer=""):
    os.makedirs(folder, exist_ok=True)
    body = "<ListRecords>" + "".join(records) + trailer + "</ListRecords>"
    with open(os.path.join(folder, name), "w", encoding="utf-8") as out:
        out.write(ENVELOPE.format(body=body))


def _token(text, size):
    return f'<resumptionToken cursor="0" completeListSize="{size}">{text}</resumptionToken>'


@pytest.fixture
def pages(folder):
    path = folder("pages")
    two = AUTHOR.format("Roe", "R.") + "<author><keyname>Group</keyname></author><author><keyname></keyname></author>"
    _page(path, "1.xml", _record("a"), DELETED, NO_ID, _record("b", authors=two), trailer=_token("next", 5))
    _page(path, "2.xml", _record("a", updated="<updated>2024-01-02</updated>", title="Second\nversion"), trailer=_token("", 5))
    _page(path, "3.xml", _record("c", authors="", title="", stamp="2025-01-01"))
    return path


def test_records_and_normalisation(spark, pages):
    records = read_oai(spark, pages)
    assert records.count() == 6
    rows = {(r.id, r.updated): r for r in normalize_oai(records).collect()}
    assert set(rows) == {("a", None), ("a", "2024-01-02"), ("b", None), ("c", None)}
    first = rows["a", None]
    assert (first.title, first.abstract, first.date) == ("A & B", "one two", "2024-01-01")
    assert first.authors == ["Jane Doe"] and first.categories == ["cs.AI", "stat.ML"]
    assert rows["b", None].authors == ["R. Roe", "Group"]
    assert rows["c", None].authors == [] and rows["c", None].title == ""
    assert rows["a", "2024-01-02"].title == "Second version" and rows["a", "2024-01-02"].date == "2024-01-02"


def test_authors_given_as_plain_text(spark, folder):
    path = folder("plain")
    _page(path, "1.xml", _record("a", authors="<author> Jane Doe </author>" + AUTHOR.format("Roe", "R.")), _record("b", authors="<author>Solo</author>"))
    assert {r.id: r.authors for r in normalize_oai(read_oai(spark, path)).collect()} == {"a": ["Jane Doe", "R. Roe"], "b": ["Solo"]}


def test_parse_pages_keeps_the_latest(spark, pages):
    rows = {(r.id, r.year): r.updated for r in parse_pages(landed_records(spark, pages)).collect()}
    assert rows == {("a", 2024): "2024-01-02", ("b", 2024): None, ("c", 2025): None}
    assert parse_pages(landed_records(spark, pages), categories=["math"]).count() == 0
    assert parse_pages(landed_records(spark, pages), categories=["stat"]).count() == 3


def _check(spark, path):
    require_complete(read_oai(spark, path), read_envelope(spark, path))


def test_envelope_and_completeness(spark, pages, folder):
    trailers = sorted((r.token or "", r.list_size) for r in read_envelope(spark, pages).collect())
    assert trailers == [("", 5), ("next", 5)]
    _check(spark, pages)
    short = folder("short")
    _page(short, "1.xml", _record("a"), trailer=_token("", 2))
    with pytest.raises(RuntimeError, match="incomplete harvest"):
        _check(spark, short)
    twice = folder("twice")
    _page(twice, "1.xml", _record("a"), _record("b"), trailer=_token("next", 4))
    _page(twice, "1-again.xml", _record("a"), _record("b"), trailer=_token("", 4))
    with pytest.raises(RuntimeError, match="incomplete harvest"):
        _check(spark, twice)
    unfinished = folder("unfinished")
    _page(unfinished, "1.xml", _record("a"), trailer=_token("next", ""))
    with pytest.raises(RuntimeError, match="incomplete harvest"):
        _check(spark, unfinished)


@pytest.mark.parametrize("code, complete", [("noRecordsMatch", True), ("badArgument", False)])
def test_error_pages(spark, folder, code, complete):
    path = folder("errors")
    os.makedirs(path)
    with open(os.path.join(path, "1.xml"), "w") as out:
        out.write(ENVELOPE.format(body=f'<error code="{code}">text</error>'))
    row = read_envelope(spark, path).first()
    assert (row.error_code, row.error_text) == (code, "text")
    if complete:
        _check(spark, path)
    else:
        with pytest.raises(RuntimeError):
            _check(spark, path)


def test_malformed_pages_are_not_complete(spark, folder):
    whole, entity, broken = folder("whole"), folder("entity"), folder("broken")
    _page(whole, "1.xml", _record("a"), _record("b"))
    _page(entity, "1.xml", _record("a"), _record("b", title="x &nbsp; y"), _record("c"))
    _page(broken, "1.xml", _record("a"), "<record><header></metadata></record>", _record("c"))
    _check(spark, whole)
    for path in (entity, broken):
        with pytest.raises(RuntimeError, match="incomplete harvest"):
            _check(spark, path)
        assert "a" in {r.id for r in parse_pages(landed_records(spark, path)).collect()}


FEED = """<?xml version='1.0' encoding='UTF-8'?>
<rss xmlns:dc="http://purl.org/dc/elements/1.1/" version="2.0"><channel><title>feed</title>{items}</channel></rss>
"""
ITEM = """<item><title>{title}</title><link>{link}</link><description>line one
line two</description><category>cs.AI</category><category>cs.LG</category><dc:creator>A. One, B. Two</dc:creator>{date}</item>"""


@pytest.fixture
def feeds(folder):
    path = folder("feeds")
    os.makedirs(path)
    items = {
        "cs.xml": [
            ITEM.format(title=" T1 ", link="http://x.org/abs/2401.1v1", date="<pubDate>Mon, 01 Jan 2024 00:00:00 -0500</pubDate>"),
            ITEM.format(title="none", link="http://x.org/list/1", date=""),
            ITEM.format(title="old", link="http://x.org/abs/solv-int/9v2", date=""),
        ],
        "stat.xml": [ITEM.format(title="T2", link="http://x.org/abs/2401.1v2", date="<pubDate>Tue, 02 Jan 2024 00:00:00 GMT</pubDate>")],
    }
    for name, entries in items.items():
        with open(os.path.join(path, name), "w", encoding="utf-8") as out:
            out.write(FEED.format(items="".join(entries)))
    return path


def test_feed_items(spark, feeds):
    items = read_rss(spark, feeds)
    assert items.count() == 4 and valid_items(items).count() == 3
    rows = {(r.id, r.title): r for r in normalize_rss(items).collect()}
    first = rows["2401.1", "T1"]
    assert first.created == first.updated == first.date == "2024-01-01T05:00:00Z"
    assert first.authors == ["A. One, B. Two"] and first.categories == ["cs.AI", "cs.LG"]
    assert first.abstract == "line one line two" and first.license is None
    assert rows["solv-int/9", "old"].date is None
    bare = {r.id: r.updated for r in normalize_rss(items, updated_from_published=False).collect()}
    assert set(bare.values()) == {None}


def test_malformed_items_do_not_hide_the_others(spark, folder):
    path = folder("feeds")
    os.makedirs(path)
    item = "<item><title>{}</title><link>http://x.org/abs/{}v1</link></item>"
    bad = ["<item><title>x<b></title></item>", item.format("x &nbsp; y", "9")]
    with open(os.path.join(path, "a.xml"), "w") as out:
        out.write(FEED.format(items=item.format("one", 1) + bad[0] + item.format("two", 2) + bad[1] + item.format("three", 3)))
    with open(os.path.join(path, "b.xml"), "w") as out:
        out.write("<rss><channel>" + item.format("four", 4) + "<item><title>cut")
    assert {r.id for r in normalize_rss(read_rss(spark, path)).collect()} == {"1", "2", "3", "4"}
    assert read_rss(spark, path).filter("link is null and _corrupt_record is not null").count() == 3


def test_feed_dedup_and_cut(spark, feeds):
    assert {(r.id, r.title) for r in parse_feeds(spark, feeds).collect()} == {("2401.1", "T1"), ("solv-int/9", "old")}
    assert {r.id for r in parse_feeds(spark, feeds, cut="first_v").collect()} == {"2401.1", "sol"}


def test_named_artifacts(spark, folder):
    root = folder("artifacts")
    for matrix, year, key, value in [(0, 2023, "m1", 1.0), (11, 2024, "m1", 2.0), (2, 2024, "m_2", 3.0)]:
        path = os.path.join(root, f"matrix-output-{matrix}")
        os.makedirs(path, exist_ok=True)
        table = pa.table({"id": ["a"], key: pa.array([[value]], pa.list_(pa.float32()))})
        pq.write_table(table, os.path.join(path, f"embedded-{year}.parquet-{key}.parquet"))
    rows = {(r.year, r.model_key): (r.id, r.vector, r.seq) for r in read_artifacts(spark, root, ["m1", "m_2"]).collect()}
    assert rows == {(2023, "m1"): ("a", [1.0], 0), (2024, "m1"): ("a", [2.0], 11), (2024, "m_2"): ("a", [3.0], 2)}
    assert read_artifacts(spark, root, ["none", "m1"]).count() == 2 and read_artifacts(spark, root, ["none"]).count() == 0


def test_task_array(spark, folder):
    path = folder("tasks")
    os.makedirs(path)
    with open(os.path.join(path, "matrix_0_tasks.json"), "w") as out:
        out.write('[\n {"id": "a", "year_file": "2024.parquet", "model_key": "m1"},\n {"id": "b", "year_file": "2023.parquet", "model_key": "m1"}\n]')
    assert sorted(map(tuple, read_task_array(spark, path).collect())) == [("a", 2024, "m1"), ("b", 2023, "m1")]


def test_years_with_different_model_columns(spark, folder):
    root = folder("years")
    spark.createDataFrame([("a",)], "id string").write.parquet(f"{root}/year=2023")
    spark.createDataFrame([("b", [1.0])], "id string, m1 array<float>").write.parquet(f"{root}/year=2024")
    assert {(r.id, r.year): r.m1 for r in read_years(spark, root).collect()} == {("a", 2023): None, ("b", 2024): [1.0]}
    assert [r.id for r in read_years(spark, root, [2023, 1999]).collect()] == ["a"]
    assert read_years(spark, root, [1999]).count() == 0
    fixed = read_years(spark, root, model_keys=["m1", "m2"])
    assert "m2" in fixed.columns and fixed.filter(F.col("m1").isNotNull()).count() == 1
    assert is_table(spark, root) and not is_table(spark, root + "-none")
