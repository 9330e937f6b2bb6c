"""Landed OAI-PMH response pages.

``read_pages`` parses every page once and whole; records and trailers come from its rows.
``read_oai`` and ``read_envelope`` read single elements, also of pages that break off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.text import author_names, flatten_text, primary_date, split_categories
from paperloom.schema import PAPER_COLUMNS

# Element names of the harvested format.
RECORD_SCHEMA = (
    "header struct<identifier:string,datestamp:string,setSpec:array<string>,_status:string>, "
    "metadata struct<arXiv:struct<id:string,created:string,updated:string,"
    "authors:struct<author:array<struct<_VALUE:string,keyname:string,forenames:string>>>,"
    "title:string,categories:string,license:string,abstract:string>>, "
    "_corrupt_record string"
)
TOKEN_SCHEMA = "_VALUE string, _completeListSize string"
ERROR_SCHEMA = "_VALUE string, _code string"
NO_RECORDS = "noRecordsMatch"
# Fixed value: names of files that Spark decompresses by their ending.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
_RECORD = f"struct<{RECORD_SCHEMA.removesuffix(', _corrupt_record string')}>"
_LIST = f"record array<{_RECORD}>, resumptionToken struct<{TOKEN_SCHEMA}>, error array<struct<{ERROR_SCHEMA}>>"
# A page's root is the response, or the list by itself.
PAGE_SCHEMA = f"{_LIST}, ListRecords struct<{_LIST}>, _corrupt_record string"


def _elements(spark: SparkSession, path: str | list[str], tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def read_oai(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per ``record`` element: ``header, metadata, identifier, page, corrupt``.

    ``corrupt`` marks a record that is not well formed, and the row without identifier
    in which a page ends when its text breaks off.
    """
    return _elements(spark, path, "record", RECORD_SCHEMA).select(
        "header",
        "metadata",
        F.col("header.identifier").alias("identifier"),
        F.col("_metadata.file_path").alias("page"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


def read_envelope(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per page trailer: ``page, token, list_size, error_code, error_text``.

    Pages that end without a token and without an error have no row.
    """
    page = F.col("_metadata.file_path").alias("page")
    none = F.lit(None).cast("string")
    token = F.nullif(F.trim("_VALUE"), F.lit(""))
    tokens = _elements(spark, path, "resumptionToken", TOKEN_SCHEMA).select(
        page,
        token.alias("token"),
        F.col("_completeListSize").try_cast("bigint").alias("list_size"),
        none.alias("error_code"),
        none.alias("error_text"),
    )
    errors = _elements(spark, path, "error", ERROR_SCHEMA).select(
        page,
        none.alias("token"),
        F.lit(None).cast("bigint").alias("list_size"),
        F.col("_code").alias("error_code"),
        F.col("_VALUE").alias("error_text"),
    )
    return tokens.unionByName(errors)


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed page: ``page, records, token, list_size, errors, corrupt``.

    Each file, plain or compressed, is read and parsed once. A page that is not well
    formed is ``corrupt`` and has nothing else; ``read_oai`` still finds its sound records.
    """
    files = spark.read.format("binaryFile").load(path)
    if not files.filter(F.col("_metadata.file_name").rlike(COMPRESSED)).isEmpty():
        # Only text files are decompressed as they are read; plain ones are read as they are.
        files = spark.read.format("text").option("wholetext", True).load(path).withColumnRenamed("value", "content")
    content = F.from_xml(F.col("content").cast("string"), PAGE_SCHEMA)
    parsed = files.select(F.col("_metadata.file_path").alias("page"), content.alias("p"))
    inner = F.col("p.ListRecords")
    token = F.coalesce("p.resumptionToken", inner["resumptionToken"])
    none = F.array().cast(f"array<struct<{ERROR_SCHEMA}>>")
    return parsed.select(
        "page",
        F.coalesce("p.record", inner["record"]).alias("records"),
        F.nullif(F.trim(token["_VALUE"]), F.lit("")).alias("token"),
        token["_completeListSize"].try_cast("bigint").alias("list_size"),
        F.concat(F.coalesce("p.error", none), F.coalesce(inner["error"], none)).alias("errors"),
        F.col("p._corrupt_record").isNotNull().alias("corrupt"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """The records of parsed pages in the form of ``read_oai``; a corrupt page is one row without identifier."""
    record = F.explode(F.when(F.col("corrupt"), F.array(F.lit(None).cast(_RECORD))).otherwise(F.col("records")))
    rows = pages.select("page", "corrupt", record.alias("r"))
    return rows.select(
        F.col("r.header").alias("header"), F.col("r.metadata").alias("metadata"),
        F.col("r.header.identifier").alias("identifier"), "page", "corrupt",
    )


def page_envelope(pages: DataFrame) -> DataFrame:
    """The trailers of parsed pages in the form of ``read_envelope``: a row for each page with token, size or error."""
    said = F.col("token").isNotNull() | F.col("list_size").isNotNull() | (F.size("errors") > 0)
    rows = pages.filter(said).select("page", "token", "list_size", F.explode_outer("errors").alias("e"))
    return rows.select("page", "token", "list_size", F.col("e._code").alias("error_code"), F.col("e._VALUE").alias("error_text"))


def landed_pages(spark: SparkSession, path: str | list[str], pages: DataFrame) -> DataFrame:
    """All records of parsed pages, with the sound ones of pages that are corrupt.

    Only if there are corrupt pages, their files are read again, element by element.
    """
    records = page_records(pages)
    broken = pages.filter("corrupt").select("page")
    if broken.isEmpty():
        return records
    return records.unionByName(read_oai(spark, path).join(broken, "page", "left_semi"))


def harvest_complete(records: DataFrame, envelope: DataFrame, source: Column) -> DataFrame:
    """Per harvested list: distinct records found, announced size, and whether the harvest is whole.

    ``source`` names the list a page belongs to. A list is whole when no page reported an
    error other than an empty result, no page is corrupt, the announced size, if any, was
    reached, and not every page asks for another one.
    """
    seen = records.groupBy("page", "identifier").agg(F.bool_or("corrupt").alias("corrupt"))
    found = seen.groupBy("page").agg(F.bool_or("corrupt").alias("corrupt"))
    # A page that was requested again delivers its records again; each counts once for its list.
    counted = seen.filter(F.col("identifier").isNotNull()).select(source.alias("source"), "identifier").distinct()
    counted = counted.groupBy("source").agg(F.count(F.lit(1)).alias("record_count"))
    failed = F.col("error_code").isNotNull() & (F.col("error_code") != NO_RECORDS)
    trailers = envelope.groupBy("page").agg(
        F.max("list_size").alias("list_size"),
        F.bool_or(failed).alias("failed"),
        F.bool_or(F.col("token").isNotNull()).alias("continued"),
    )
    lists = found.join(trailers, ["page"], "full_outer").groupBy(source.alias("source")).agg(
        F.max("list_size").alias("list_size"),
        F.bool_or(F.coalesce("failed", F.lit(False)) | F.coalesce("corrupt", F.lit(False))).alias("failed"),
        (F.count_if("continued") < F.count(F.lit(1))).alias("ended"),
    )
    lists = lists.join(counted, ["source"], "left").withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("bigint")))
    reached = F.col("record_count") >= F.coalesce("list_size", "record_count")
    complete = ~F.col("failed") & reached & F.col("ended")
    return lists.select("source", "record_count", "list_size", complete.alias("complete"))


def valid_records(records: DataFrame) -> DataFrame:
    """Records with metadata and an id; deleted records have neither."""
    return records.filter(F.coalesce(F.col("metadata.arXiv.id"), F.lit("")) != "")


def normalize_oai(records: DataFrame, *extra: Column | str, only_valid: bool = True) -> DataFrame:
    """Records in the paper schema, plus any ``extra`` columns such as the page.

    Records that are not valid are dropped, or with ``only_valid=False`` kept without id.
    """
    meta = F.col("metadata.arXiv")
    paper = {
        "id": F.nullif(meta["id"], F.lit("")),
        "title": flatten_text(meta["title"]),
        "authors": author_names(meta["authors"]["author"], plain="_VALUE"),
        "abstract": flatten_text(meta["abstract"]),
        "date": primary_date(meta["updated"], meta["created"]),
        "categories": split_categories(meta["categories"]),
        "created": meta["created"],
        "updated": meta["updated"],
        "license": meta["license"],
    }
    rows = valid_records(records) if only_valid else records
    return rows.select(*[paper[c].alias(c) for c in PAPER_COLUMNS], *extra)
