"""Splitting work into lists, and the backlog-and-split job."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.split import split_summary, split_tasks
from paperloom.plans.embedding import assign_backlog
from queries import query
from queries.derived import (
    MODELS,
    PAPER_TABLE,
    SQL_NEEDS,
    VECTOR_TABLE,
    paper_table,
    table,
    vector_table,
    with_papers,
)


def sql_split(tasks: str, lists: int = 10, cap: int | None = None) -> str:
    """CTEs that split the rows ``(id, year, model_key)`` of the CTE ``tasks``."""
    per = f"ceil(task_total / {lists})::bigint"
    per = f"least({per}, {cap})" if cap else per
    return f"""ranked as (
      select *, row_number() over (order by md5('42|' || id || '|' || year || '|' || model_key)) - 1 as task_rank,
        count(*) over () as task_total from {tasks}
    ), assigned as (
      select id, year, model_key, task_total, task_rank, (task_rank // ({per}))::int as matrix_id
      from ranked where task_rank < ({per}) * {lists}
    )"""


def line_tasks(spark, sf_dir):
    """A task per lineitem; the same order, year and flag give the same task."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("model_key"),
    )


LINE_TASKS = """line_tasks as (
  select l_orderkey::varchar as id, year(l_shipdate)::int as year, l_returnflag as model_key from lineitem
)"""
ORDER_TASKS = """order_tasks as (
  select o_orderkey::varchar as id, year(o_orderdate)::int as year, o_orderpriority as model_key from orders
)"""


def order_tasks(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("model_key"),
    )


@query("t1_split_tasks", f"with {LINE_TASKS}, {sql_split('line_tasks')} select * from assigned")
def t1_split_tasks(spark, sf_dir):
    return split_tasks(line_tasks(spark, sf_dir))


@query("t1_split_capped", f"with {ORDER_TASKS}, {sql_split('order_tasks', 7, 1000)} select * from assigned")
def t1_split_capped(spark, sf_dir):
    return split_tasks(order_tasks(spark, sf_dir), lists=7, max_per_list=1000, unique=True)


@query(
    "g11_split_summary",
    f"with {ORDER_TASKS}, {sql_split('order_tasks', 7, 1000)} select max(task_total) as total_tasks, "
    "count(*) as assigned_tasks, max(task_total) - count(*) as dropped_tasks, "
    "count(distinct matrix_id) as matrix_count, '[' || string_agg(distinct '{\"matrix_id\":' || matrix_id || '}', "
    "',' order by '{\"matrix_id\":' || matrix_id || '}') || ']' as matrices from assigned",
)
def g11_split_summary(spark, sf_dir):
    return split_summary(t1_split_capped(spark, sf_dir))


BACKLOG = f"""backlog as (
  select p.id, p.year, 'm1' as model_key from paper_table p
    left join vector_newest v on v.id = p.id and v.year = p.year where {SQL_NEEDS.format(c='v.vector')}
  union all select id, year, 'm2' from paper_table
)"""


@query(
    "x6_backlog_split",
    with_papers("select * from assigned", PAPER_TABLE, VECTOR_TABLE, BACKLOG, sql_split("backlog")),
)
def x6_backlog_split(spark, sf_dir):
    papers = paper_table(spark, sf_dir).select("id", "year")
    return assign_backlog(papers, vector_table(spark, sf_dir), MODELS, unique=True)
