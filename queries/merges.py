"""Upserts and incremental merges."""

from __future__ import annotations

from paperloom.operators.backlog import backlog
from paperloom.operators.dedup import latest
from paperloom.operators.upsert import change_counts, merge_latest
from paperloom.operators.years import with_year
from paperloom.plans import merge_increment, upsert_years
from paperloom.plans.merge import upserted
from paperloom.schema import ModelSpec
from paperloom.session import shared_dir
from paperloom.sinks.tables import write_artifacts, write_years
from paperloom.sources.tables import read_vectors, read_years
from pyspark.sql import functions as F
from queries import query
from queries.dedup_union import UPDATES, base_and_updates
from queries.derived import INCREMENT, PAPER_TABLE, increment, paper_table, papers, with_papers

# The keyed table both merges start from: the latest version of every paper.
EXISTING = """existing as (
  select id, seq, title, updated from (select *, row_number() over
    (partition by id order by updated desc nulls last, seq) as rn from papers) where rn = 1
)"""
COLUMNS = ["id", "seq", "title", "updated"]


def existing(spark, sf_dir):
    return latest(papers(spark, sf_dir), tie=("seq",)).select(*COLUMNS)


def sql_merged(nulls: str) -> str:
    return f"""merged as (
      select * exclude (rn) from (select *, row_number() over
        (partition by id order by updated desc nulls {nulls}, seq, title) as rn from
        (select * from existing union all select id, seq, title, updated from increment)) where rn = 1
    )"""


@query(
    "x5_merge_latest", with_papers("select * from merged", EXISTING, INCREMENT, sql_merged("last"))
)
def x5_merge_latest(spark, sf_dir):
    new = increment(spark, sf_dir).select(*COLUMNS)
    return merge_latest(existing(spark, sf_dir), new, tie=("seq", "title"))


@query(
    "x5_merge_nulls_first", with_papers("select * from merged", EXISTING, INCREMENT, sql_merged("first"))
)
def x5_merge_nulls_first(spark, sf_dir):
    new = increment(spark, sf_dir).select(*COLUMNS)
    return merge_latest(existing(spark, sf_dir), new, nulls="first", tie=("seq", "title"))


@query(
    "g2_added_count",
    with_papers(
        "select count(*) filter (e.id is null) as inserted, "
        "count(*) filter (e.id is not null and m.seq is distinct from e.seq or e.updated is distinct from m.updated "
        "and e.id is not null) as updated, "
        "count(*) filter (e.id is not null and m.seq is not distinct from e.seq and e.updated is not distinct from m.updated) "
        "as unchanged, count(*) - count(e.id) as net_growth "
        "from merged m left join existing e on e.id = m.id",
        EXISTING, INCREMENT, sql_merged("last"),
    ),
)
def g2_added_count(spark, sf_dir):
    before = existing(spark, sf_dir)
    return change_counts(before, x5_merge_latest(spark, sf_dir))




@query(
    "x5_merge_incremental",
    with_papers(
        "select id, 2024 as year, max(updated) as updated from (select id, updated from papers "
        "union all select id, updated from increment) group by id",
        INCREMENT,
    ),
)
def x5_merge_incremental(spark, sf_dir):
    """The whole job on a stored table: first load of a year, then the merge into it."""
    root = shared_dir(spark, "q-merge")
    columns = ["id", "title", "updated", "created"]
    merge_increment(spark, papers(spark, sf_dir).select(*columns), root, 2024)
    merge_increment(spark, increment(spark, sf_dir).select(*columns), root, 2024)
    return read_years(spark, root, [2024]).select("id", "year", "updated")


@query(
    "a6_first_load",
    with_papers("select id, 2024 as year, max(updated) as updated from papers group by id"),
)
def a6_first_load(spark, sf_dir):
    root = shared_dir(spark, "q-first")
    merge_increment(spark, papers(spark, sf_dir).select("id", "title", "updated"), root, 2024)
    return read_years(spark, root).select("id", "year", "updated")


BY_YEAR = UPDATES + """, final as (
  select id, year, updated, amount from (select *, row_number() over (partition by id, year
    order by is_new desc, updated desc, n desc, part desc, supp desc, amount desc) as rn
  from (select *, year(updated::date)::int as year, 0 as is_new from base
        union all select *, year(updated::date)::int, 1 from updates)) where rn = 1
)"""
ARRIVAL = ("updated", "n", "part", "supp", "amount")


@query("y3_upsert_by_year", f"with {BY_YEAR} select * from final")
def y3_upsert_by_year(spark, sf_dir):
    base, updates = (with_year(df, "updated", ("yyyy-MM-dd",)) for df in base_and_updates(spark, sf_dir))
    return upserted(base, updates, ARRIVAL).select("id", "year", "updated", "amount")


@query("x4_upsert", f"with {BY_YEAR} select * from final")
def x4_upsert(spark, sf_dir):
    """The whole job on a stored table: orders by year, then lineitems upserted into it."""
    root = shared_dir(spark, "q-upsert")
    base, updates = base_and_updates(spark, sf_dir)
    write_years(with_year(base, "updated", ("yyyy-MM-dd",)), root)
    upsert_years(spark, updates, root, rule="updated", formats=("yyyy-MM-dd",), arrival=ARRIVAL)
    return read_years(spark, root).select("id", "year", "updated", "amount")


@query(
    "x4_upsert_papers",
    with_papers(
        "select id, year, seq, title from (select *, row_number() over (partition by id, year order by is_new desc, seq desc) "
        "as rn from (select id, year, seq, title, 0 as is_new from paper_table union all "
        "select id, year(try_strptime(created, '%Y-%m-%dT%H:%M:%SZ'))::int, seq, title, 1 from increment)) where rn = 1",
        PAPER_TABLE, INCREMENT,
    ),
)
def x4_upsert_papers(spark, sf_dir):
    old = paper_table(spark, sf_dir).select("id", "year", "seq", "title")
    new = with_year(increment(spark, sf_dir)).select("id", "year", "seq", "title")
    return upserted(old, new, ("seq",)).select("id", "year", "seq", "title")


@query(
    "x5_redelivery_wide",
    with_papers(
        "select id, 2024 as year, seq, title, updated, m1 is not null as has_vector from (select *, row_number() over "
        "(partition by id order by updated desc nulls last, seq) as rn from papers) where rn = 1"
    ),
)
def x5_redelivery_wide(spark, sf_dir):
    """A wide stored year gets its own records again, without vectors: nothing changes."""
    root = shared_dir(spark, "q-redelivered")
    stored = latest(papers(spark, sf_dir), tie=("seq",)).select(*COLUMNS, "m1")
    write_years(with_year(stored, 2024), root)
    merge_increment(spark, stored.drop("m1"), root, 2024)
    return read_years(spark, root).select("id", "year", "seq", "title", "updated", F.col("m1").isNotNull().alias("has_vector"))


@query(
    "x4_forget",
    with_papers(
        "select i.id, 2024 as year, 'm1' as model_key from (select *, row_number() over (partition by id order by seq desc) as rn "
        "from increment) i left join existing e on e.id = i.id where rn = 1 and (e.id is null or i.seq <> e.seq "
        "or i.title is distinct from e.title or i.updated is distinct from e.updated)",
        EXISTING, INCREMENT,
    ),
)
def x4_forget(spark, sf_dir):
    """Every stored paper has a vector; after an upsert the backlog is what the batch changed or added."""
    root, vectors_root = shared_dir(spark, "q-forget"), shared_dir(spark, "q-forget-vectors")
    models = {"m1": ModelSpec("m1", "one", 1)}
    stored = with_year(existing(spark, sf_dir), 2024)
    write_years(stored, root)
    vector = {"model_key": F.lit("m1"), "vector": F.array(F.lit(1.0).cast("float")), "vector_sum": F.lit(1.0), "seq": F.lit(0).cast("bigint")}
    write_artifacts(stored.select("id", "year").withColumns(vector), vectors_root)
    batch = increment(spark, sf_dir).select(*COLUMNS)
    upsert_years(spark, batch, root, rule=2024, arrival=("seq",), models=models, vectors_root=vectors_root)
    table = read_years(spark, root)
    return backlog(table, read_vectors(spark, vectors_root), models)
