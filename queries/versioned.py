"""The same jobs on versioned tables, and merges of records that are delivered again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paperloom.operators.dedup import latest
from paperloom.operators.years import with_year
from paperloom.plans import harvest_years, merge_artifacts, merge_increment, upsert_years
from paperloom.session import shared_dir
from paperloom.sinks.tables import replace_years, write_years
from paperloom.sources.tables import read_years
from paperloom.streaming import stream_table, upsert_stream
from paperloom.versions import commits, create_table, drop_versions, read_table
from queries import query
from queries.dedup_union import base_and_updates
from queries.derived import INCREMENT, PAPER_TABLE, increment, paper_table, papers, with_papers
from queries.harvest import SQL_PAPER, STAMP, flat
from queries.landing import land_pages
from queries.merges import ARRIVAL, BY_YEAR, COLUMNS
from queries.tables_io import ORDER_TABLE, order_table
from queries.vectors import OVERLAY_SQL, artifacts, finite_sum

BUCKETS = 8


def _table(spark, purpose, df, buckets=BUCKETS):
    """A versioned table that holds ``df``."""
    root = shared_dir(spark, purpose)
    create_table(spark, root, df.schema, buckets)
    replace_years(df, root)
    return root


@query(
    "k2_versioned_replace",
    f"with {ORDER_TABLE} select id, case when year in (1996, 1998) then -amount else amount end as amount, year from order_table",
)
def k2_versioned_replace(spark, sf_dir):
    """Two years are switched by one commit, computed from the commit before."""
    root = _table(spark, "q-versioned", order_table(spark, sf_dir))
    changed = read_years(spark, root, [1996, 1998]).withColumn("amount", -F.col("amount"))
    replace_years(changed, root)
    return read_years(spark, root)


@query(
    "k2_versioned_history",
    f"with {ORDER_TABLE} select 1 as commit, count(*) as n, sum(case when amount < 0 then 1 else 0 end)::bigint as negative from order_table "
    f"union all select 2, count(*), sum(case when year = 1996 then 1 else 0 end)::bigint from order_table "
    f"union all select 3, count(*) filter (year <> 1997 or right(id, 1) = '0'), count(*) filter (year = 1996) from order_table",
)
def k2_versioned_history(spark, sf_dir):
    """Every commit of a table stays readable until it is dropped."""
    root = _table(spark, "q-history", order_table(spark, sf_dir))
    replace_years(read_years(spark, root, [1996]).withColumn("amount", -F.col("amount")), root)
    replace_years(read_years(spark, root, [1997]).filter(F.right("id", F.lit(1)) == "0"), root)
    drop_versions(spark, root, keep=3)
    out = None
    for number in commits(spark, root):
        counts = read_table(spark, root, number=number).agg(
            F.lit(number).alias("commit"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("amount") < 0).alias("negative")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "s4_stored_schema",
    with_papers(
        "select year, count(*) as n, count(case when year % 2 = 0 then m1 end) as m1, count(case when year % 2 = 1 then m1 end) as m2 "
        "from paper_table group by year",
        PAPER_TABLE,
    ),
)
def s4_stored_schema(spark, sf_dir):
    """Years are written with different model columns and read alike, by the schema that the commits carry."""
    table = paper_table(spark, sf_dir).select("id", "year", "title", "m1")
    root = _table(spark, "q-schema", table.filter("year % 2 = 0"))
    replace_years(table.filter("year % 2 = 1").withColumnRenamed("m1", "m2"), root)
    return read_years(spark, root).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count("m1").alias("m1"), F.count("m2").alias("m2"))


@query("x4_bucketed_upsert", f"with {BY_YEAR} select * from final")
def x4_bucketed_upsert(spark, sf_dir):
    """The upsert by year on a versioned table: only parts that the batch's ids fall in are rewritten."""
    base, updates = base_and_updates(spark, sf_dir)
    root = _table(spark, "q-bucketed-upsert", with_year(base, "updated", ("yyyy-MM-dd",)))
    upsert_years(spark, updates, root, rule="updated", formats=("yyyy-MM-dd",), arrival=ARRIVAL)
    return read_years(spark, root).select("id", "year", "updated", "amount")


@query(
    "x5_bucketed_merge",
    with_papers(
        "select id, 2024 as year, max(updated) as updated from (select id, updated from papers "
        "union all select id, updated from increment) group by id",
        INCREMENT,
    ),
)
def x5_bucketed_merge(spark, sf_dir):
    """First load of a year and the merge into it, on a versioned table."""
    columns = ["id", "title", "updated", "created"]
    root = shared_dir(spark, "q-bucketed-merge")
    create_table(spark, root, with_year(papers(spark, sf_dir).select(*columns), 2024).schema, BUCKETS)
    merge_increment(spark, papers(spark, sf_dir).select(*columns), root, 2024)
    merge_increment(spark, increment(spark, sf_dir).select(*columns), root, 2024)
    return read_years(spark, root, [2024]).select("id", "year", "updated")


@query(
    "st2_bucketed_upsert",
    with_papers(
        "select id, 2024 as year, title, updated from (select *, row_number() over "
        "(partition by id order by updated desc nulls last) as rn from papers) where rn = 1"
    ),
)
def st2_bucketed_upsert(spark, sf_dir):
    """Micro-batches replace the parts of a versioned table that they touch."""
    rows = papers(spark, sf_dir).select("id", "title", "updated", "created")
    landed, root = shared_dir(spark, "q-bucketed-batches"), shared_dir(spark, "q-bucketed-stream")
    create_table(spark, root, with_year(rows, 2024).schema, BUCKETS)
    rows.repartition(4).write.parquet(landed)
    stream = stream_table(spark, landed, rows.schema, max_files=2)
    upsert_stream(stream, root, shared_dir(spark, "q-bucketed-state"), rule=2024, keep="latest").awaitTermination()
    return read_years(spark, root).select("id", "year", "title", "updated")


@query("x8_bucketed_artifacts", OVERLAY_SQL)
def x8_bucketed_artifacts(spark, sf_dir):
    """Artifacts overlaid on a versioned table."""
    root = _table(spark, "q-bucketed-artifacts", paper_table(spark, sf_dir).select("id", "year", "seq", "title", "m1"))
    merge_artifacts(spark, root, artifacts(spark, sf_dir), ["m1", "m2"])
    merged = read_years(spark, root)
    return merged.select("id", "year", "seq", finite_sum("m1").alias("m1_sum"), finite_sum("m2").alias("m2_sum"))


REDELIVERED = with_papers(
    "select id, 2024 as year, seq, title, updated, m1 is not null as has_vector from (select *, row_number() over "
    "(partition by id order by updated desc nulls last, seq) as rn from papers) where rn = 1"
)


@query("x4_redelivery_wide", REDELIVERED)
def x4_redelivery_wide(spark, sf_dir):
    """A wide table gets its own records upserted again, without vectors: nothing changes."""
    root = shared_dir(spark, "q-upserted-again")
    stored = latest(papers(spark, sf_dir), tie=("seq",)).select(*COLUMNS, "m1")
    write_years(with_year(stored, 2024), root)
    upsert_years(spark, stored.drop("m1"), root, rule=2024)
    return read_years(spark, root).select("id", "year", "seq", "title", "updated", F.col("m1").isNotNull().alias("has_vector"))


@query(
    "x1_merge_wide",
    with_papers(
        f"select year, {SQL_PAPER}, true as has_vector from (select *, row_number() over (partition by id, year "
        "order by updated desc nulls last) as rn from (select *, "
        f"year(({STAMP})::date)::int as year from papers where source <> 'src3')) where rn = 1"
    ),
)
def x1_merge_wide(spark, sf_dir):
    """A harvest is merged into the wide table that it built: every paper keeps its vector."""
    root, years = shared_dir(spark, "q-merged-again"), list(range(2017, 2026))
    pages = land_pages(spark, sf_dir, trailers=False)
    harvest_years(spark, pages, root, years, today=dt.date(2025, 6, 30))
    replace_years(read_years(spark, root).withColumn("m1", F.array(F.lit(1.0).cast("float"))), root)
    harvest_years(spark, pages, root, years, today=dt.date(2025, 6, 30), mode="merge")
    return flat(read_years(spark, root), "year", F.col("m1").isNotNull().alias("has_vector"))
