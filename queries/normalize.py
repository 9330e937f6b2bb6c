"""Record normalisation, text preparation, date windows and year assignment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paperloom.functions.dates import feed_date, request_window, within, year_of, year_request
from paperloom.functions.text import (
    WHITESPACE,
    author_names,
    embed_text,
    flatten_text,
    has_abs_link,
    id_from_link,
    in_categories,
    non_empty,
    primary_date,
    split_categories,
)
from paperloom.operators.years import BOTH_FORMATS, split_valid, with_year
from paperloom.sources.oai import valid_records
from queries import query
from queries.derived import SQL_YEAR, papers, table, with_papers

SQL_SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
SQL_RUN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
DATE_STAMP = "'%Y-%m-%dT%H:%M:%SZ'"


def sql_strip(expr: str) -> str:
    return f"trim({expr}, {SQL_SPACES})"


@query(
    "p1_flatten_text",
    "select doc_id, "
    + sql_strip("replace(coalesce(text, ''), chr(10), ' ')")
    + " as flat, "
    + sql_strip("replace(coalesce(chr(160) || lang || chr(10), ''), chr(10), ' ')")
    + " as short_flat from documents",
)
def p1_flatten_text(spark, sf_dir):
    padded = F.concat(F.lit("\xa0"), "lang", F.lit("\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", flatten_text("text").alias("flat"), flatten_text(padded).alias("short_flat")
    )


@query(
    "p2_author_names",
    with_papers(
        "select seq, array_to_string(names, '|') as names, len(names) as name_count from (select seq, "
        "list_filter(list_transform(string_split(coalesce(title, ''), ' '), lambda w: "
        + sql_strip("(case when w like '%.' then '' else lang end) || ' ' || w")
        + "), lambda n: n <> '') as names from papers)"
    ),
)
def p2_author_names(spark, sf_dir):
    words = F.split(F.coalesce("title", F.lit("")), " ")
    authors = F.transform(
        words, lambda w: F.struct(w.alias("keyname"), F.when(~w.endswith("."), F.col("lang")).alias("forenames"))
    )
    named = papers(spark, sf_dir).select("seq", author_names(authors).alias("n"))
    return named.select("seq", F.array_join("n", "|").alias("names"), F.size("n").cast("bigint").alias("name_count"))


@query(
    "p3_rss_authors",
    with_papers(
        "select seq, array_to_string(list_filter(list_concat(string_split(abstract, chr(10)), [null, title]), "
        "lambda n: coalesce(n, '') <> ''), '|') as names from papers"
    ),
)
def p3_rss_authors(spark, sf_dir):
    lines = F.coalesce(F.split("abstract", "\n"), F.array().cast("array<string>"))
    raw = F.concat(lines, F.array(F.lit(None).cast("string"), F.col("title")))
    return papers(spark, sf_dir).select("seq", F.array_join(non_empty(raw), "|").alias("names"))


@query(
    "p4_split_categories",
    with_papers(
        f"select seq, array_to_string(list_filter(regexp_split_to_array(chr(9) || categories_raw || '  ', '{SQL_RUN}'), "
        "lambda x: x <> ''), '|') as categories, "
        f"len(list_filter(regexp_split_to_array(coalesce(abstract, ''), '{SQL_RUN}'), lambda x: x <> '')) as part_count "
        "from papers"
    ),
)
def p4_split_categories(spark, sf_dir):
    padded = F.concat(F.lit("\t"), "categories_raw", F.lit("  "))
    return papers(spark, sf_dir).select(
        "seq",
        F.array_join(split_categories(padded), "|").alias("categories"),
        F.size(split_categories("abstract")).cast("bigint").alias("part_count"),
    )


@query(
    "p5_tags",
    "select doc_id, array_to_string(list_filter([lang, '', null, source, lang || '.' || source], "
    "lambda x: coalesce(x, '') <> ''), '|') as tags from documents",
)
def p5_tags(spark, sf_dir):
    tags = F.array(
        F.col("lang"), F.lit(""), F.lit(None).cast("string"), F.col("source"), F.concat("lang", F.lit("."), "source")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(non_empty(tags), "|").alias("tags"))


@query(
    "p6_primary_date",
    with_papers(
        "select seq, coalesce(nullif(case when lang = 'de' then '' else updated end, ''), created) as date from papers"
    ),
)
def p6_primary_date(spark, sf_dir):
    updated = F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("updated"))
    return papers(spark, sf_dir).select("seq", primary_date(updated, "created").alias("date"))


LINKS = """links as (
  select doc_id as item, 'http://papers.example.org/abs/solv-' || lang || '/' || doc_id || 'v' || (n_chars % 7) as link
  from documents union all select page_id, url || '/abs/' || page_id from pages union all select page_id, url from pages
)"""


def _links(spark, sf_dir):
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    made = docs.select(
        F.col("doc_id").alias("item"),
        F.concat(F.lit("http://papers.example.org/abs/solv-"), "lang", F.lit("/"), "doc_id", F.lit("v"),
                 (F.col("n_chars") % 7).cast("string")).alias("link"),
    )
    tailed = pages.select("page_id", F.concat("url", F.lit("/abs/"), "page_id"))
    return made.union(tailed).union(pages.select("page_id", "url"))


@query(
    "p7_id_from_link",
    f"with {LINKS} select item, link, regexp_replace(string_split(link, '/abs/')[-1], 'v[0-9]+$', '') as id, "
    "split_part(string_split(link, '/abs/')[-1], 'v', 1) as id_first_v from links where contains(link, '/abs/')",
)
def p7_id_from_link(spark, sf_dir):
    return _links(spark, sf_dir).filter(has_abs_link("link")).select(
        "item", "link", id_from_link("link").alias("id"), id_from_link("link", "first_v").alias("id_first_v")
    )


@query("p9_valid_items", f"with {LINKS} select item, link from links where contains(link, '/abs/')")
def p9_valid_items(spark, sf_dir):
    return _links(spark, sf_dir).filter(has_abs_link("link"))


@query(
    "p8_format_ts",
    "select event_id, strftime(ts + case event_type when 'view' then interval 5 hour when 'click' then "
    f"interval (-90) minute else interval 0 hour end, {DATE_STAMP}) as stamp from events",
)
def p8_format_ts(spark, sf_dir):
    zone = F.when(F.col("event_type") == "view", "-0500").when(F.col("event_type") == "click", "+0130")
    text = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" "), zone.otherwise("GMT"))
    return table(spark, sf_dir, "events").select("event_id", feed_date(text).alias("stamp"))


@query(
    "p9_valid_records",
    "select 'oai:' || doc_id as identifier from documents where lang <> 'de' and source <> 'src3'",
)
def p9_valid_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    paper_id = F.when(F.col("source") != "src3", F.col("doc_id").cast("string")).otherwise("")
    metadata = F.when(F.col("lang") != "de", F.struct(F.struct(paper_id.alias("id")).alias("arXiv")))
    records = docs.select(F.concat(F.lit("oai:"), "doc_id").alias("identifier"), metadata.alias("metadata"))
    return valid_records(records).select("identifier")


@query(
    "p11_category_filter",
    with_papers(
        "select seq, categories_raw from papers where len(list_filter(string_split(categories_raw, ' '), "
        "lambda c: c in ('en', 'de.src1') or c like 'en.%' or c like 'de.src1.%')) > 0"
    ),
)
def p11_category_filter(spark, sf_dir):
    rows = papers(spark, sf_dir).filter(in_categories(split_categories("categories_raw"), ["en", "de.src1"]))
    return rows.select("seq", "categories_raw")


@query(
    "p12_date_window",
    "select o_orderkey, o_totalprice from orders where o_orderdate >= timestamp '1998-06-01' "
    "and o_orderdate < timestamp '1998-07-01'",
)
def p12_date_window(spark, sf_dir):
    window = request_window(until=dt.date(1998, 6, 30), days=29)
    orders = table(spark, sf_dir, "orders").filter(within("o_orderdate", window, "timestamp"))
    return orders.select("o_orderkey", "o_totalprice")


@query(
    "p12_year_window",
    with_papers("select seq, created from papers where created >= '2020-01-01' and created < '2020-07-16'"),
)
def p12_year_window(spark, sf_dir):
    window = year_request(2020, today=dt.date(2020, 7, 15))
    return papers(spark, sf_dir).filter(within("created", window)).select("seq", "created")


@query(
    "p13_embed_text",
    with_papers("select seq, coalesce(title, '') || chr(10) || coalesce(abstract, '') as text from papers"),
)
def p13_embed_text(spark, sf_dir):
    return papers(spark, sf_dir).select("seq", embed_text().alias("text"))


@query(
    "y1_extract_year",
    with_papers(
        "select seq, created, year(try_strptime(created, '%Y-%m-%dT%H:%M:%SZ'))::int as year, "
        + SQL_YEAR.format(c="created") + " as year_either from papers"
    ),
)
def y1_extract_year(spark, sf_dir):
    return papers(spark, sf_dir).select(
        "seq", "created", year_of("created").alias("year"), year_of("created", BOTH_FORMATS).alias("year_either")
    )


@query(
    "y2_invalid_year",
    with_papers("select id, seq, created from papers where try_strptime(created, '%Y-%m-%dT%H:%M:%SZ') is null"),
)
def y2_invalid_year(spark, sf_dir):
    _, invalid = split_valid(with_year(papers(spark, sf_dir)))
    return invalid.select("id", "seq", "created")


@query(
    "y2_invalid_head",
    with_papers(
        "select id, seq, created from papers where try_strptime(created, '%Y-%m-%dT%H:%M:%SZ') is null "
        "order by seq limit 5"
    ),
)
def y2_invalid_head(spark, sf_dir):
    return y2_invalid_year(spark, sf_dir).orderBy("seq").limit(5)
