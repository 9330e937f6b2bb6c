"""Landed pages and feeds, written by Spark from the given documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.session import open_writers, shared_dir
from queries.derived import bare_papers, papers, table

STAMP = "coalesce(updated, substr(created, 1, 10), '2019-01-01')"


def land_pages(spark, sf_dir, trailers: bool = True) -> str:
    """Harvest pages of every paper version, one folder per language.

    Records of one source are deleted ones. Trailers announce the number of records; that
    of the German list is too large and the Spanish list ends in an error. Pages are gzipped.
    """
    root = shared_dir(spark, "landed-pages")
    rows = bare_papers(spark, sf_dir)
    words = F.split(F.coalesce("title", F.lit("")), " ")
    authors = F.transform(
        words, lambda w: F.struct(w.alias("keyname"), F.when(~w.endswith("."), F.col("lang")).alias("forenames"))
    )
    paper = F.struct(
        "id",
        "created",
        "updated",
        F.struct(authors.alias("author")).alias("authors"),
        "title",
        F.col("categories_raw").alias("categories"),
        "abstract",
    )
    deleted = F.col("source") == "src3"
    header = F.struct(
        F.concat(F.lit("oai:"), "seq").alias("identifier"),
        F.expr(STAMP).alias("datestamp"),
        F.when(deleted, "deleted").alias("_status"),
    )
    records = rows.select("lang", header.alias("header"), F.when(~deleted, F.struct(paper.alias("arXiv"))).alias("metadata"))
    # Documents scanned in enough parts are written where they are read; others are spread first.
    tasks = spark.sparkContext.defaultParallelism
    _append(records if table(spark, sf_dir, "documents").rdd.getNumPartitions() >= tasks else records.repartition(tasks), root, "record")
    if trailers:
        lists = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        size = F.col("n") + F.when(F.col("lang") == "de", 5).otherwise(0)
        _append(lists.select("lang", size.alias("_completeListSize"), F.lit("").alias("_VALUE")), root, "resumptionToken")
        failed = lists.filter(F.col("lang") == "es")
        _append(failed.select("lang", F.lit("badResumptionToken").alias("_code"), F.lit("expired").alias("_VALUE")), root, "error")
    return root


def _append(df: DataFrame, root: str, tag: str) -> None:
    # A page of a harvest holds a limited number of records.
    writer = df.write.format("xml").mode("append").option("rootTag", "ListRecords").option("rowTag", tag)
    with open_writers(df.sparkSession):
        writer.option("maxRecordsPerFile", 1000).option("compression", "gzip").partitionBy("lang").save(root)


#: Items of one landed feed.
FEED_ITEMS = 200


def land_feeds(spark, sf_dir) -> str:
    """Feeds of one language each, their items in the order of ``seq``; items of one source do not link to a paper."""
    root = shared_dir(spark, "landed-feeds")
    path = F.when(F.col("source") == "src3", "/list/").otherwise("/abs/")
    when = F.try_to_timestamp("created", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    items = papers(spark, sf_dir).select(
        F.format_string("%s-%08d", "lang", F.floor(F.col("seq") / FEED_ITEMS)).alias("feed"),
        "seq",
        F.concat(F.lit("http://papers.example.org"), path, "id", F.lit("v"), "seq").alias("link"),
        "title",
        F.col("abstract").alias("description"),
        F.array("source", F.lit(None).cast("string"), "lang").alias("dc:creator"),
        F.split("categories_raw", " ").alias("category"),
        F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("pubDate"),
    )
    entry = F.to_xml(F.struct(*[c for c in items.columns if c not in ("feed", "seq")]), {"rowTag": "item", "validateName": "false"})
    feeds = items.groupBy("feed").agg(F.sort_array(F.collect_list(F.struct("seq", entry.alias("text")))).alias("items"))
    head = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'
    text = F.concat(F.lit(head), F.array_join("items.text", "\n"), F.lit("</channel></rss>")).alias("value")
    feeds.select("feed", text).write.partitionBy("feed").text(root)
    return root
