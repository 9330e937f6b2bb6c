"""Running a task list: vectors and the outcome of every task."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.backlog import backlog
from paperloom.operators.embed import hash_encoder
from paperloom.plans import run_tasks
from queries import query
from queries.derived import DIM, MODELS, PAPER_TABLE, VECTOR_TABLE, paper_table, vector_table, with_papers
from queries.joins_reports import RUN_LOG, run_log
from queries.splits import BACKLOG, ORDER_TASKS, order_tasks
from queries.vectors import SQL_BYTE_SUM, SQL_BYTES, SQL_TEXT, _bytes

TASKS = """tasks as (
  select * from backlog
  union all select id, year, 'm1' from order_tasks
  union all select id, year, 'm3' from run_log
)"""


def _run(spark, sf_dir):
    """The backlog, plus tasks of papers the table lacks and of a model nobody configured."""
    papers = paper_table(spark, sf_dir)
    tasks = (
        backlog(papers, vector_table(spark, sf_dir), MODELS)
        .union(order_tasks(spark, sf_dir).withColumn("model_key", F.lit("m1")))
        .union(run_log(spark, sf_dir).select("id", "year", F.lit("m3")))
    )
    encoders = {key: hash_encoder(DIM) for key in MODELS}
    cores = spark.sparkContext.defaultParallelism
    return run_tasks(papers, tasks, MODELS, encoders, seq=1, partitions=cores)


CTES = (PAPER_TABLE, VECTOR_TABLE, BACKLOG, ORDER_TASKS, RUN_LOG, TASKS)


@query(
    "x7_run_tasks",
    with_papers(
        "select id, year, model_key, case when error is null then 'processed' else 'failed' end as status, error from ("
        "select t.id, t.year, t.model_key, case when t.model_key = 'm3' then 'no configuration for model m3' "
        "when p.id is null then 'id is not in the table for this year' end as error "
        "from tasks t left join paper_table p on p.id = t.id and p.year = t.year)",
        *CTES,
    ),
)
def x7_run_tasks(spark, sf_dir):
    return _run(spark, sf_dir).status.select("id", "year", "model_key", "status", "error")


@query(
    "x7_vectors",
    with_papers(
        f"select id, year, model_key, {SQL_BYTES}, {SQL_BYTE_SUM} as byte_sum from (select b.id, b.year, b.model_key, "
        f"{SQL_TEXT} from backlog b join paper_table p on p.id = b.id and p.year = b.year)",
        PAPER_TABLE, VECTOR_TABLE, BACKLOG,
    ),
)
def x7_vectors(spark, sf_dir):
    return _run(spark, sf_dir).vectors.select("id", "year", "model_key", *_bytes(F.col("vector")))
