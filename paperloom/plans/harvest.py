"""From landed pages and feeds to deduplicated, sorted paper tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.dates import WINDOW_DAYS, request_window, within, year_of, year_request
from paperloom.functions.text import in_categories
from paperloom.operators.align import united
from paperloom.operators.dedup import first_by, latest, without_keys
from paperloom.operators.upsert import winning
from paperloom.operators.years import BOTH_FORMATS
from paperloom.schema import PAPER_COLUMNS
from paperloom.session import cut_lineage, scoped
from paperloom.sinks.tables import replace_touched, replace_years, write_snapshot
from paperloom.sources.oai import harvest_complete, landed_pages, normalize_oai, page_envelope, read_pages
from paperloom.sources.rss import landed_items, normalize_rss, read_feeds
from paperloom.sources.tables import is_table, read_touched, table_state, touched


def landed_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every landed record in the paper schema, with its datestamp, identifier and page.

    Deleted and unidentified records are kept without id: they count towards the size a
    harvest announces.
    """
    return _records(spark, path, _parsed(spark, path))


def _parsed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # Parsed once; the completeness check and the table both read the parsed pages.
    return cut_lineage(read_pages(spark, path), "pages")


def _records(spark: SparkSession, path: str | list[str], pages: DataFrame) -> DataFrame:
    stamp = F.col("header.datestamp").alias("datestamp")
    return normalize_oai(landed_pages(spark, path, pages), stamp, "identifier", "page", "corrupt", only_valid=False)


def checked_records(spark: SparkSession, path: str | list[str], check_complete: bool = True) -> DataFrame:
    """Every landed record, after the harvest was found complete if that is to be checked."""
    pages = _parsed(spark, path)
    records = _records(spark, path, pages)
    if check_complete:
        require_complete(records, page_envelope(pages))
    return records


def parse_pages(
    records: DataFrame,
    window: tuple[dt.date, dt.date] | None = None,
    categories: Sequence[str] = (),
    year: int | None = None,
    keys: Sequence[str] = ("id", "year"),
) -> DataFrame:
    """Latest version per id and year, or other ``keys``, of the valid landed records.

    The pages are usually the answer to a request for a window and categories; both are
    applied again here. Requests select by the record's datestamp, and so do the window
    and the ``year`` column; a record without one is kept and gets ``year``.
    """
    return latest(_asked(records, window, categories, year), keys).select(*PAPER_COLUMNS, "year")


def _asked(
    records: DataFrame, window: tuple[dt.date, dt.date] | None, categories: Sequence[str], year: int | None
) -> DataFrame:
    """Valid records of a window and categories, all versions, with their year."""
    stamp = F.col("datestamp")
    papers = records.filter(F.col("id").isNotNull())
    if categories:
        papers = papers.filter(in_categories("categories", list(categories)))
    if window:
        papers = papers.filter(stamp.isNull() | within(stamp, window))
    return papers.withColumn("year", F.coalesce(year_of(stamp, BOTH_FORMATS), F.lit(year).cast("int")))


def require_complete(records: DataFrame, envelope: DataFrame) -> None:
    """Raise if landed records and page trailers are an unfinished or failed harvest.

    Pages of one list lie in one folder.
    """
    folder = F.regexp_extract("page", r"^(.*)/[^/]+$", 1)
    broken = harvest_complete(records, envelope, folder).filter(~F.col("complete")).limit(10).collect()
    if broken:
        raise RuntimeError(f"incomplete harvest: {[tuple(row) for row in broken]}")


@scoped
def harvest_years(
    spark: SparkSession,
    path: str | list[str],
    root: str,
    years: Sequence[int],
    today: dt.date,
    categories: Sequence[str] = (),
    mode: str = "replace",
    check_complete: bool = True,
) -> int:
    """Build years of the table from their landed pages, in one job. Returns rows written.

    Unless ``check_complete`` is off, the harvest must be complete and its pages well
    formed. ``replace`` rebuilds a year from nothing else; ``merge`` keeps papers
    of the existing year that the harvest lacks, and the later version of those in both.
    Years without a record stay as they are.
    """
    if mode not in ("replace", "merge"):
        raise ValueError(f"mode must be replace or merge, not {mode}")
    records = checked_records(spark, path, check_complete)
    window = (year_request(min(years), today)[0], year_request(max(years), today)[1])
    only = years[0] if len(years) == 1 else None
    papers = parse_pages(records, window, categories, only)
    papers = papers.filter(F.col("year").isin(list(years)))
    if mode == "merge" and is_table(spark, root):
        found = _asked(records, window, categories, only).filter(F.col("year").isin(list(years))).select("id", "year")
        return _merge_harvest(spark, papers, found, root)
    return replace_years(papers, root)


def _merge_harvest(spark: SparkSession, papers: DataFrame, found: DataFrame, root: str) -> int:
    """Put harvested papers that are new or later than the stored ones into the table. Returns rows written.

    Every stored column stays, model columns too; a paper that is harvested as it is stored
    keeps its row, and with it its vectors. Without a change nothing is written. ``found``
    has the ``id`` and ``year`` of the papers, maybe more than once.
    """
    keys, state = ("id", "year"), table_state(spark, root)
    parts = touched(found, state)
    if not parts:
        return 0
    stored = read_touched(spark, root, parts, state)
    winners = cut_lineage(winning(stored, papers, keys, "updated"), "winners")
    if winners.isEmpty():
        return 0
    old, new = united(without_keys(stored, winners, keys), winners)
    return replace_touched(old.unionByName(new), root, parts, state)


@scoped
def harvest_window(
    spark: SparkSession,
    path: str | list[str],
    output: str,
    until: dt.date,
    days: int = WINDOW_DAYS,
    start: dt.date | None = None,
    categories: Sequence[str] = (),
    check_complete: bool = True,
) -> int:
    """Build one increment from the landed pages of a date window. Returns its rows.

    Unless ``check_complete`` is off, the harvest must be complete and its pages well
    formed. An empty window still writes a table with the paper schema.
    """
    records = checked_records(spark, path, check_complete)
    newest = parse_pages(records, request_window(until, days, start), categories, keys=("id",))
    return write_snapshot(newest.select(*PAPER_COLUMNS), output)


def parse_feeds(
    spark: SparkSession,
    path: str | list[str],
    cut: str = "version",
    updated_from_published: bool = True,
    feed: Column | None = None,
) -> DataFrame:
    """First entry of every paper in the landed feeds, in the order of ``feed`` and of the entries in it.

    ``feed`` is the file's path unless given. Feeds are parsed once and whole. Entries of
    feeds that are not well formed have no position: they come after the others of their
    feed, by date, link, then content.
    """
    order = (F.col("feed") if feed is None else feed).alias("__feed")
    items = landed_items(spark, path, cut_lineage(read_feeds(spark, path), "feeds"))
    papers = normalize_rss(
        items, order, "position", "link", cut=cut, updated_from_published=updated_from_published
    )
    arrival = [F.col("__feed").asc(), F.col("position").asc_nulls_last(), F.col("date").asc(), F.col("link").asc()]
    return first_by(papers, ("id",), arrival).select(*PAPER_COLUMNS)


@scoped
def harvest_feed(
    spark: SparkSession, path: str | list[str], output: str, cut: str = "version"
) -> int:
    """Build the current snapshot from landed feeds. Returns its rows; none writes nothing."""
    return write_snapshot(cut_lineage(parse_feeds(spark, path, cut), "feed"), output, on_empty="skip")

