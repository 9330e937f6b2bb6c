"""Pages and feeds parsed once and whole."""

import datetime as dt
import os

import paperloom.plans.harvest as harvest
import pytest
from paperloom.plans import harvest_feed, harvest_window, harvest_years
from paperloom.plans.harvest import checked_records, landed_records, parse_feeds, parse_pages
from paperloom.sources import oai
from paperloom.sources.oai import harvest_complete, page_envelope, page_records, read_envelope, read_oai, read_pages
from paperloom.sources.rss import feed_items, normalize_rss, read_feeds, read_rss
from paperloom.sources.tables import read_years
from pyspark.sql import functions as F
from test_sources import AUTHOR, DELETED, ENVELOPE, FEED, ITEM, NO_ID, _page, _record, _token, feeds, pages  # noqa: F401

FOLDER = r"^(.*)/[^/]+$"


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_whole_pages_equal_single_elements(spark, pages, folder):  # noqa: F811
    errors = folder("errors")
    os.makedirs(errors)
    with open(os.path.join(errors, "1.xml"), "w") as out:
        out.write(ENVELOPE.format(body='<error code="badArgument">text</error><error code="noRecordsMatch">none</error>'))
    for path in (pages, errors, [pages, errors]):
        whole = read_pages(spark, path)
        assert _rows(page_records(whole)) == _rows(read_oai(spark, path))
        assert _rows(page_envelope(whole)) == _rows(read_envelope(spark, path))
    whole, listed = read_pages(spark, pages), F.regexp_extract("page", FOLDER, 1)
    assert _rows(harvest_complete(page_records(whole), page_envelope(whole), listed)) == _rows(
        harvest_complete(read_oai(spark, pages), read_envelope(spark, pages), listed)
    )


def test_a_harvest_scans_its_pages_once(spark, pages, folder, monkeypatch):  # noqa: F811
    plans = []
    real = harvest.cut_lineage

    def seen(df, purpose):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, purpose)

    def refused(*_):
        raise AssertionError("well formed pages are not read element by element")

    monkeypatch.setattr(harvest, "cut_lineage", seen)
    monkeypatch.setattr(oai, "read_oai", refused)
    assert harvest_years(spark, pages, folder("table"), [2024, 2025], dt.date(2025, 6, 1)) == 3
    scans = [p for _, plan in plans for p in plan.splitlines() if "FileScan" in p]
    assert [p for p, _ in plans] == ["pages"] and len(scans) == 1 and "FileScan binaryFile" in scans[0]


def test_malformed_pages_are_told_and_their_sound_records_kept(spark, folder):
    path = folder("broken")
    _page(path, "1.xml", _record("a"), _record("b"))
    _page(path, "2.xml", _record("c"), "<record><header></metadata></record>", _record("d"))
    assert {r.page.rsplit("/", 1)[1] for r in read_pages(spark, path).filter("corrupt").collect()} == {"2.xml"}
    assert {"a", "b", "c"} <= {r.id for r in parse_pages(landed_records(spark, path)).collect()}
    with pytest.raises(RuntimeError, match="incomplete harvest"):
        checked_records(spark, path)


def test_a_window_keeps_one_version_with_one_shuffle(spark, folder):
    path = folder("pages")
    _page(path, "1.xml", _record("a", stamp="2023-12-31", title="old"), _record("a", stamp="2024-01-01", updated="<updated>2024-01-01</updated>", title="new"))
    output = folder("window")
    assert harvest_window(spark, path, output, until=dt.date(2024, 1, 1)) == 1
    assert [r.title for r in spark.read.parquet(output).collect()] == ["new"]
    plan = parse_pages(landed_records(spark, path), keys=("id",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def _feed(path, name, *items, form=FEED):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as out:
        out.write(form.format(items="".join(items)))


def test_the_first_entry_of_a_feed_stays(spark, folder):
    """Copies of a paper with equal dates and links that sort the other way."""
    path, output = folder("feeds"), folder("out")
    date = "<pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate>"
    many = [ITEM.format(title=f"first {k}", link=f"http://x.org/abs/{k}v9", date=date) for k in range(50)]
    again = [ITEM.format(title=f"again {k}", link=f"http://x.org/abs/{k}v1", date=date) for k in range(60)]
    _feed(path, "b.xml", *many, *again)
    _feed(path, "c.xml", ITEM.format(title="other feed", link="http://x.org/abs/3v1", date=""))
    rows = {r.id: r.title for r in parse_feeds(spark, path).collect()}
    assert rows == {str(k): f"first {k}" if k < 50 else f"again {k}" for k in range(60)}
    assert harvest_feed(spark, path, output) == 60
    assert {r.id: r.title for r in spark.read.parquet(output).collect()} == rows
    # Another order of feeds: the second feed comes first.
    turned = parse_feeds(spark, path, feed=F.when(F.contains("feed", F.lit("c.xml")), 0).otherwise(1))
    assert {r.id: r.title for r in turned.collect()} == rows | {"3": "other feed"}


def test_authors_and_licenses_of_feeds(spark, folder):
    path = folder("feeds")
    _feed(
        path, "rss.xml",
        "<item><title>a</title><link>http://x/abs/1v1</link><author>jo@x.org (Jo Doe)</author><author>only@x.org</author></item>",
        '<item><title>b</title><link>http://x/abs/2v1</link><dc:creator>A</dc:creator><dc:creator>B</dc:creator>'
        '<cc:license xmlns:cc="http://c">L1</cc:license></item>',
        '<item><title>c</title><link>http://x/abs/3v1</link><author>Ann Lee</author><dc:creator>C</dc:creator><license>L2</license></item>',
    )
    atom = '<feed xmlns="http://www.w3.org/2005/Atom">{items}</feed>'
    _feed(
        path, "z.xml",
        '<entry><title>d</title><link href="http://x/abs/4v2"/><link rel="license" href="L3"/><author><name>N</name></author>'
        '<author><name>M</name><email>m@x.org</email></author><category term="cs.AI"/><summary>text</summary>'
        "<published>2024-01-01T00:00:00Z</published><updated>2024-01-02T00:00:00Z</updated></entry>",
        form=atom,
    )
    items = feed_items(read_feeds(spark, path))
    rows = {r.id: r for r in normalize_rss(items, "position").collect()}
    assert {k: (r.authors, r.license, r.position) for k, r in rows.items()} == {
        "1": (["Jo Doe"], None, 0), "2": (["A", "B"], "L1", 1), "3": (["Ann Lee", "C"], "L2", 2), "4": (["N", "M"], "L3", 0),
    }
    entry = rows["4"]
    assert (entry.categories, entry.abstract, entry.created, entry.updated) == (["cs.AI"], "text", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")


def test_whole_feeds_equal_single_items(spark, feeds):  # noqa: F811
    assert _rows(normalize_rss(feed_items(read_feeds(spark, feeds)))) == _rows(normalize_rss(read_rss(spark, feeds)))
