"""Deduplication, unions and sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.align import union_all
from paperloom.operators.dedup import keep_first, latest, new_wins
from paperloom.operators.years import distinct_years
from queries import query
from queries.derived import papers, table, with_papers

LINE_TIE = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_SQL = ", ".join(LINE_COLUMNS)
TIE_SQL = ", ".join(LINE_TIE)


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


@query(
    "d1_latest_nulls_last",
    f"select {LINE_SQL}, strftime(l_shipdate, '%Y-%m-%d') as shipped from (select *, row_number() over "
    f"(partition by l_orderkey order by l_shipdate desc nulls last, {TIE_SQL}) as rn from lineitem) where rn = 1",
)
def d1_latest_nulls_last(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_quantity", "l_shipdate")
    newest = latest(lines, ("l_orderkey",), "l_shipdate", tie=LINE_TIE)
    return newest.select(*LINE_COLUMNS, _day("l_shipdate").alias("shipped"))


@query(
    "d1_latest_papers",
    with_papers(
        "select id, seq, updated, title from (select *, row_number() over "
        "(partition by id order by updated desc nulls last, seq) as rn from papers) where rn = 1"
    ),
)
def d1_latest_papers(spark, sf_dir):
    return latest(papers(spark, sf_dir), tie=("seq",)).select("id", "seq", "updated", "title")


@query(
    "d2_latest_nulls_first",
    f"select {LINE_SQL}, strftime(due, '%Y-%m-%d') as shipped from (select *, row_number() over "
    f"(partition by l_orderkey order by due desc nulls first, {TIE_SQL}) as rn from "
    "(select *, case when l_returnflag = 'R' then null else l_shipdate end as due from lineitem)) where rn = 1",
)
def d2_latest_nulls_first(spark, sf_dir):
    due = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_quantity", due.alias("due"))
    newest = latest(lines, ("l_orderkey",), "due", nulls="first", tie=LINE_TIE)
    return newest.select(*LINE_COLUMNS, _day("due").alias("shipped"))


@query(
    "d2_latest_papers",
    with_papers(
        "select id, seq, updated from (select *, row_number() over "
        "(partition by id order by updated desc nulls first, seq) as rn from papers) where rn = 1"
    ),
)
def d2_latest_papers(spark, sf_dir):
    return latest(papers(spark, sf_dir), nulls="first", tie=("seq",)).select("id", "seq", "updated")


@query(
    "d3_keep_first",
    "select user_id, event_id, event_type from (select *, row_number() over "
    "(partition by user_id order by event_type, event_id) as rn from events) where rn = 1",
)
def d3_keep_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return keep_first(events, ("user_id",), ("event_type", "event_id"))


UPDATES = """updates as (
  select l_orderkey as id, strftime(l_shipdate, '%Y-%m-%d') as updated, l_extendedprice as amount,
    l_linenumber as n, l_partkey as part, l_suppkey as supp from lineitem
), base as (
  select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as updated, o_totalprice as amount,
    0 as n, 0 as part, 0 as supp from orders
)"""


def base_and_updates(spark, sf_dir):
    """Orders as existing rows and their lineitems as a batch with many rows per id."""
    zero = F.lit(0)
    base = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), _day("o_orderdate").alias("updated"), F.col("o_totalprice").alias("amount"),
        zero.alias("n"), zero.cast("bigint").alias("part"), zero.cast("bigint").alias("supp"),
    )
    updates = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), _day("l_shipdate").alias("updated"), F.col("l_extendedprice").alias("amount"),
        F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
    )
    return base, updates


@query(
    "d4_new_wins",
    f"with {UPDATES} select id, updated, amount from (select *, row_number() over (partition by id "
    "order by is_new desc, updated desc, n desc, part desc, supp desc, amount desc) as rn "
    "from (select *, 0 as is_new from base union all select *, 1 from updates)) where rn = 1",
)
def d4_new_wins(spark, sf_dir):
    base, updates = base_and_updates(spark, sf_dir)
    merged = new_wins(base, updates, ("id",), ("updated", "n", "part", "supp", "amount"))
    return merged.select("id", "updated", "amount")


@query(
    "u1_union_all",
    f"with {UPDATES} select id, updated, amount from base union all select id, updated, amount from updates",
)
def u1_union_all(spark, sf_dir):
    base, updates = base_and_updates(spark, sf_dir)
    return union_all(base, updates).select("id", "updated", "amount")


@query(
    "u2_union_widen",
    "select l_linenumber::bigint as n, strftime(l_shipdate, '%Y-%m-%d') as day from lineitem "
    "union all select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') from orders",
)
def u2_union_widen(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("n"), _day("l_shipdate").alias("day"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"), _day("o_orderdate").alias("day"))
    return union_all(lines, orders)


@query(
    "u3_union_sources",
    "select 'documents' as source, doc_id as id, lang as label from documents "
    "union all select 'pages', page_id, null from pages "
    "union all select 'events', event_id, event_type from events",
)
def u3_union_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    pages = table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"))
    events = table(spark, sf_dir, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("event_type").alias("label"))
    return union_all(docs, pages, events)


@query("u4_distinct_years", "select distinct year(o_orderdate)::int as year from orders order by year")
def u4_distinct_years(spark, sf_dir):
    return distinct_years(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")))


@query("w1_sort_id", with_papers("select id, seq, title from papers order by id, seq"))
def w1_sort_id(spark, sf_dir):
    return papers(spark, sf_dir).select("id", "seq", "title").orderBy("id", "seq")
