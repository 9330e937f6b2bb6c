"""Landed pages and feeds, read back, checked and harvested."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paperloom.plans import harvest_feed, harvest_window, harvest_years
from paperloom.plans.harvest import parse_feeds
from paperloom.session import cut_lineage, shared_dir
from paperloom.sources.oai import harvest_complete, normalize_oai, page_envelope, page_records, read_envelope, read_oai, read_pages
from paperloom.sources.rss import normalize_rss, read_rss
from paperloom.sources.tables import read_years
from queries import query
from queries.derived import with_papers
from queries.landing import STAMP, land_feeds, land_pages
from queries.normalize import sql_strip

SQL_FLAT = sql_strip("replace(coalesce({c}, ''), chr(10), ' ')")
SQL_AUTHORS = (
    "array_to_string(list_filter(list_transform(string_split(coalesce(title, ''), ' '), lambda w: "
    + sql_strip("(case when w like '%.' then '' else lang end) || ' ' || w")
    + "), lambda n: n <> ''), '|')"
)
SQL_PAPER = (
    f"id, {SQL_FLAT.format(c='title')} as title, {SQL_AUTHORS} as authors, {SQL_FLAT.format(c='abstract')} as abstract, "
    "coalesce(updated, created) as date, replace(categories_raw, ' ', '|') as categories, created, updated"
)


def flat(df, *extra):
    """Paper columns with arrays as text."""
    return df.select(
        *extra, "id", "title", F.array_join("authors", "|").alias("authors"), "abstract", "date",
        F.array_join("categories", "|").alias("categories"), "created", "updated",
    )


SCAN_SQL = with_papers(f"select 'oai:' || seq as identifier, {SQL_PAPER} from papers where source <> 'src3'")


@query("s1_oai_scan", SCAN_SQL)
def s1_oai_scan(spark, sf_dir):
    records = read_oai(spark, land_pages(spark, sf_dir))
    return flat(normalize_oai(records, F.col("header.identifier").alias("identifier")), "identifier")


@query(
    "s2_harvest_complete",
    "select lang as source, count(*) as record_count, count(*) + case when lang = 'de' then 5 else 0 end as list_size, "
    "lang not in ('de', 'es') as complete from documents group by lang",
)
def s2_harvest_complete(spark, sf_dir):
    root = land_pages(spark, sf_dir)
    folder = F.regexp_extract("page", r"/lang=([^/]+)/", 1)
    return harvest_complete(read_oai(spark, root), read_envelope(spark, root), folder)


@query(
    "x1_harvest",
    with_papers(
        f"select year, {SQL_PAPER} from (select *, row_number() over (partition by id, year "
        "order by updated desc nulls last) as rn from (select *, "
        f"year(({STAMP})::date)::int as year from papers where source <> 'src3')) where rn = 1"
    ),
)
def x1_harvest(spark, sf_dir):
    """The whole job: all landed years, deduplicated per year and written."""
    root = shared_dir(spark, "q-harvest")
    pages = land_pages(spark, sf_dir, trailers=False)
    harvest_years(spark, pages, root, list(range(2017, 2026)), today=dt.date(2025, 6, 30))
    return flat(read_years(spark, root), "year")


@query(
    "x2_harvest_window",
    with_papers(
        f"select {SQL_PAPER} from (select *, row_number() over (partition by id order by updated desc nulls last) as rn "
        f"from papers where source <> 'src3' and {STAMP} between '2020-03-01' and '2021-02-28') where rn = 1"
    ),
)
def x2_harvest_window(spark, sf_dir):
    output = shared_dir(spark, "q-window")
    pages = land_pages(spark, sf_dir, trailers=False)
    harvest_window(spark, pages, output, until=dt.date(2021, 2, 28), start=dt.date(2020, 3, 1))
    return flat(spark.read.parquet(output))


SQL_FEED_STAMP = "strftime(try_strptime(created, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ')"
SQL_ITEM = (
    f"id, {SQL_FLAT.format(c='title')} as title, source || '|' || lang as authors, "
    f"{SQL_FLAT.format(c='abstract')} as abstract, stamp as date, replace(categories_raw, ' ', '|') as categories, "
    "stamp as created, stamp as updated"
)


@query(
    "s3_rss_scan",
    with_papers(f"select {SQL_ITEM} from (select *, {SQL_FEED_STAMP} as stamp from papers) where source <> 'src3'"),
)
def s3_rss_scan(spark, sf_dir):
    return flat(normalize_rss(read_rss(spark, land_feeds(spark, sf_dir))))


@query(
    "x3_rss",
    with_papers(
        f"select {SQL_ITEM} from (select *, row_number() over (partition by id order by lang, seq) as rn "
        f"from (select *, {SQL_FEED_STAMP} as stamp from papers) where source <> 'src3') where rn = 1"
    ),
)
def x3_rss(spark, sf_dir):
    feeds = land_feeds(spark, sf_dir)
    return flat(parse_feeds(spark, feeds, feed=F.regexp_extract("feed", r"/feed=([^/]+)/", 1)))


FEED_FIRST = with_papers(
    f"select {SQL_ITEM} from (select *, row_number() over (partition by id order by lang desc, seq) as rn "
    f"from (select *, {SQL_FEED_STAMP} as stamp from papers) where source <> 'src3') where rn = 1"
)


@query("d3_feed_order", FEED_FIRST)
def d3_feed_order(spark, sf_dir):
    """Feeds in another order: the first entry of a paper is that of the last language, and the first one there."""
    feeds = land_feeds(spark, sf_dir)
    place = F.regexp_extract("feed", r"/feed=([a-z]+)-(\d+)/", 1)
    ranked = F.translate(place, "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba")
    return flat(parse_feeds(spark, feeds, feed=F.struct(ranked, F.regexp_extract("feed", r"/feed=([a-z]+)-(\d+)/", 2))))


@query(
    "x3_harvest_feed",
    with_papers(
        f"select {SQL_ITEM} from (select *, row_number() over (partition by id order by lang, seq) as rn "
        f"from (select *, {SQL_FEED_STAMP} as stamp from papers) where source <> 'src3') where rn = 1"
    ),
)
def x3_harvest_feed(spark, sf_dir):
    """The whole job: landed feeds to a written snapshot."""
    output = shared_dir(spark, "q-feed")
    harvest_feed(spark, land_feeds(spark, sf_dir), output)
    return flat(spark.read.parquet(output))


@query("s1_page_scan", SCAN_SQL)
def s1_page_scan(spark, sf_dir):
    """Records of pages that are parsed whole."""
    records = page_records(read_pages(spark, land_pages(spark, sf_dir)))
    return flat(normalize_oai(records, F.col("header.identifier").alias("identifier")), "identifier")


@query(
    "s2_page_complete",
    "select lang as source, count(*) as record_count, count(*) + case when lang = 'de' then 5 else 0 end as list_size, "
    "lang not in ('de', 'es') as complete from documents group by lang",
)
def s2_page_complete(spark, sf_dir):
    """Completeness from pages that are parsed once for records and trailers."""
    pages = cut_lineage(read_pages(spark, land_pages(spark, sf_dir)), "q-pages")
    return harvest_complete(page_records(pages), page_envelope(pages), F.regexp_extract("page", r"/lang=([^/]+)/", 1))


@query(
    "x1_harvest_checked",
    with_papers(
        f"select year, {SQL_PAPER} from (select *, row_number() over (partition by id, year "
        "order by updated desc nulls last) as rn from (select *, "
        f"year(({STAMP})::date)::int as year from papers where source <> 'src3' and lang not in ('de', 'es'))) where rn = 1"
    ),
)
def x1_harvest_checked(spark, sf_dir):
    """The lists whose trailers say that they are whole, harvested with that check."""
    root, pages = shared_dir(spark, "q-checked"), land_pages(spark, sf_dir)
    listed = spark.read.format("binaryFile").load(pages).select(F.regexp_extract("_metadata.file_path", r"/lang=([^/]+)/", 1)).distinct()
    whole = [f"{pages}/lang={r[0]}" for r in listed.collect() if r[0] not in ("de", "es")]
    harvest_years(spark, whole, root, list(range(2017, 2026)), today=dt.date(2025, 6, 30))
    return flat(read_years(spark, root), "year")
