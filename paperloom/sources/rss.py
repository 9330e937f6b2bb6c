"""Landed feeds, RSS and Atom.

``read_feeds`` parses every feed once and whole, so entries have positions; ``read_rss``
reads single items, also of feeds that are not well formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.dates import feed_date
from paperloom.functions.text import flatten_text, has_abs_link, id_from_link, non_empty, primary_date
from paperloom.schema import PAPER_COLUMNS

# Element names of the feed format.
ITEM_SCHEMA = (
    "link string, title string, description string, `dc:creator` array<string>, "
    "category array<string>, pubDate string, `dc:date` string, license string, "
    "_corrupt_record string"
)
# The same elements without their namespaces; authors are names or elements with a name.
_TEXT = "array<struct<_VALUE:string,_term:string>>"
_AUTHOR = "array<struct<_VALUE:string,name:string,email:string>>"
_LINK = "array<struct<_VALUE:string,_href:string,_rel:string>>"
_LICENSE = "array<struct<_VALUE:string,_resource:string>>"
_ENTRY = (
    f"link:{_LINK},title:string,description:string,summary:string,creator:array<string>,author:{_AUTHOR},"
    f"category:{_TEXT},pubDate:string,published:string,date:string,updated:string,license:{_LICENSE}"
)
FEED_SCHEMA = (
    f"channel struct<item:array<struct<{_ENTRY}>>>, item array<struct<{_ENTRY}>>, "
    f"entry array<struct<{_ENTRY}>>, _corrupt_record string"
)
_MAIL = r"\(?<?[^\s()<>]+@[^\s()<>]+>?\)?"


def read_rss(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per ``item`` element with the feed it came from.

    An item that is not well formed keeps its text in ``_corrupt_record`` and has no link;
    the items after it are read all the same, which takes Spark's element-wise parser.
    """
    reader = spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE")
    reader = reader.option("useLegacyXMLParser", "true")
    return reader.schema(ITEM_SCHEMA).load(path).withColumn("feed", F.col("_metadata.file_path"))


def read_feeds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed feed: ``feed, entries, corrupt``; each file is read and parsed once.

    A feed that is not well formed is ``corrupt`` and has no entries; ``read_rss`` still
    finds its sound items.
    """
    files = spark.read.format("binaryFile").load(path)
    feed = F.from_xml(F.col("content").cast("string"), FEED_SCHEMA, {"ignoreNamespace": "true"}).alias("f")
    parsed = files.select(F.col("_metadata.file_path").alias("feed"), feed)
    return parsed.select(
        "feed", F.coalesce("f.channel.item", "f.item", "f.entry").alias("entries"), F.col("f._corrupt_record").isNotNull().alias("corrupt")
    )


def feed_items(feeds: DataFrame) -> DataFrame:
    """The entries of parsed feeds in the form of ``read_rss``, with their ``position``.

    Names come from ``author`` elements, then ``creator`` elements; mail addresses are no
    names. A license is an element of that name in any namespace, its text or the resource
    it points to, or a link that says so.
    """
    rows = feeds.select("feed", F.posexplode("entries").alias("position", "e"))
    links = F.coalesce("e.link", F.array().cast(_LINK))
    plain = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    licensed = F.filter(links, lambda x: F.coalesce(x["_rel"] == "license", F.lit(False)))
    named = F.transform("e.author", lambda a: F.coalesce(a["name"], F.btrim(F.regexp_replace(a["_VALUE"], _MAIL, ""), F.lit(" ()<>\n\t"))))
    plain, licensed, license_ = F.get(plain, F.lit(0)), F.get(licensed, F.lit(0)), F.get("e.license", F.lit(0))
    return rows.select(
        F.coalesce(plain["_VALUE"], plain["_href"]).alias("link"), F.col("e.title").alias("title"),
        F.coalesce("e.description", "e.summary").alias("description"),
        F.concat(F.coalesce(named, F.array().cast("array<string>")), F.coalesce("e.creator", F.array().cast("array<string>"))).alias("dc:creator"),
        F.transform("e.category", lambda c: F.coalesce(c["_term"], c["_VALUE"])).alias("category"),
        F.coalesce("e.pubDate", "e.published").alias("pubDate"), F.coalesce("e.date", "e.updated").alias("dc:date"),
        F.coalesce(licensed["_href"], license_["_resource"], license_["_VALUE"]).alias("license"),
        "feed", "position",
    )


def landed_items(spark: SparkSession, path: str | list[str], feeds: DataFrame) -> DataFrame:
    """All entries of parsed feeds, with the sound items, without position, of feeds that are corrupt.

    Only if there are corrupt feeds, their files are read again, item by item.
    """
    items = feed_items(feeds)
    broken = feeds.filter("corrupt").select("feed")
    if broken.isEmpty():
        return items
    sound = read_rss(spark, path).join(broken, "feed", "left_semi").withColumn("position", F.lit(None).cast("int"))
    return items.unionByName(sound.drop("_corrupt_record"))


def valid_items(items: DataFrame) -> DataFrame:
    return items.filter(has_abs_link("link"))


def normalize_rss(
    items: DataFrame, *extra: Column | str, cut: str = "version", updated_from_published: bool = True
) -> DataFrame:
    """Items that link to a paper, in the paper schema, plus any ``extra`` columns.

    ``updated_from_published`` lets a feed without update dates report the publication
    date as both, which is what common feed readers do.
    """
    created = feed_date("pubDate")
    updated = F.coalesce(feed_date("dc:date"), created) if updated_from_published else feed_date("dc:date")
    paper = {
        "id": id_from_link("link", cut),
        "title": flatten_text("title"),
        "authors": non_empty("dc:creator"),
        "abstract": flatten_text("description"),
        "date": primary_date(updated, created),
        "categories": non_empty("category"),
        "created": created,
        "updated": updated,
        "license": F.col("license"),
    }
    return valid_items(items).select(*[paper[c].alias(c) for c in PAPER_COLUMNS], *extra)
