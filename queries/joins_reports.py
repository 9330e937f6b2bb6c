"""Task joins and run reports, with events as the log of a run.

Every event is one task: its user is the paper, its month-day bucket the year, its type
the outcome. ``error`` events failed, with their properties as the reason; ``signup``
events failed without a recorded reason.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.status import (
    failure_head,
    failure_top,
    model_keys,
    per_model_year,
    per_source,
    remaining,
    step_counts,
    task_summary,
    tasks_of_papers,
    unprocessed,
    with_model,
)
from queries import query
from queries.derived import MODELS, PAPER_TABLE, VECTOR_TABLE, paper_table, papers, table, vector_table, with_papers
from queries.splits import LINE_TASKS, ORDER_TASKS, line_tasks, order_tasks


def run_log(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.dayofmonth("ts").alias("year"),
        F.when(F.col("value") > 20, "m1").when(F.col("value") > 10, "m2").otherwise("m3").alias("model_key"),
        F.when(kind.isin("error", "signup"), "failed").otherwise("processed").alias("status"),
        F.when(kind == "error", F.concat(F.lit("encoder failed on properties "), "props")).alias("error"),
    )


RUN_LOG = """run_log as (
  select event_id::varchar as id, day(ts)::int as year,
    case when value > 20 then 'm1' when value > 10 then 'm2' else 'm3' end as model_key,
    case when event_type in ('error', 'signup') then 'failed' else 'processed' end as status,
    case when event_type = 'error' then 'encoder failed on properties ' || props end as error
  from events
)"""


@query(
    "j1_task_semi",
    with_papers(
        "select p.id, p.seq, p.year, p.title from paper_table p where exists "
        "(select 1 from vector_newest v where v.id = p.id and v.year = p.year)",
        PAPER_TABLE, VECTOR_TABLE,
    ),
)
def j1_task_semi(spark, sf_dir):
    tasks = vector_table(spark, sf_dir).select("id", "year", "model_key")
    return tasks_of_papers(paper_table(spark, sf_dir), tasks).select("id", "seq", "year", "title")


@query(
    "j4_unprocessed",
    f"with {LINE_TASKS}, {ORDER_TASKS} select *, 'no vector was produced for this id' as error from line_tasks t "
    "where not exists (select 1 from order_tasks o where o.id = t.id and o.year = t.year)",
)
def j4_unprocessed(spark, sf_dir):
    return unprocessed(line_tasks(spark, sf_dir), order_tasks(spark, sf_dir), on=("id", "year"))


@query(
    "j5_missing_model",
    f"with {RUN_LOG} select id, model_key, case model_key when 'm1' then 'encoder-one' when 'm2' then 'encoder-two' "
    "end as model_name, case when model_key = 'm3' then 'no configuration for model m3' end as error from run_log",
)
def j5_missing_model(spark, sf_dir):
    tasks = run_log(spark, sf_dir).drop("error", "status")
    return with_model(tasks, MODELS).select("id", "model_key", "model_name", "error")


@query(
    "j6_remaining",
    f"with {RUN_LOG}, {ORDER_TASKS} select id, year, model_key, 'encoder stopped before this task' as error "
    "from order_tasks t where not exists (select 1 from run_log r where r.id = t.id)",
)
def j6_remaining(spark, sf_dir):
    return remaining(order_tasks(spark, sf_dir), run_log(spark, sf_dir), on=("id",))


@query(
    "g1_step_counts",
    with_papers(
        "select 'harvested' as step, count(*) as row_count from papers union all select 'valid', count(*) from papers "
        "where coalesce(try_strptime(created, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(created, '%Y-%m-%d')) is not null "
        "union all select 'deduplicated', count(*) from paper_table",
        PAPER_TABLE,
    ),
)
def g1_step_counts(spark, sf_dir):
    from paperloom.operators.years import BOTH_FORMATS, split_valid, with_year

    rows = papers(spark, sf_dir)
    valid, _ = split_valid(with_year(rows, "created", BOTH_FORMATS))
    return step_counts(harvested=rows, valid=valid, deduplicated=paper_table(spark, sf_dir))


@query("g5_per_source", "select source, count(*) as record_count from documents group by source")
def g5_per_source(spark, sf_dir):
    return per_source(table(spark, sf_dir, "documents"))


@query(
    "g6_tasks_by_model_year",
    f"with {LINE_TASKS} select model_key, year, count(*) as task_count from line_tasks group by all",
)
def g6_tasks_by_model_year(spark, sf_dir):
    return per_model_year(line_tasks(spark, sf_dir))


SUMMARY = (
    "count(*) as attempted, count(*) filter (status = 'processed') as succeeded, "
    "count(*) filter (status = 'failed') as failed, "
    "100.0::double * count(*) filter (status = 'processed') / count(*) as success_percent, "
    "bool_or(status = 'failed') as any_failed"
)


@query("g7_task_summary", f"with {RUN_LOG} select {SUMMARY} from run_log")
def g7_task_summary(spark, sf_dir):
    return task_summary(run_log(spark, sf_dir))


@query("g7_summary_by_model", f"with {RUN_LOG} select model_key, {SUMMARY} from run_log group by model_key")
def g7_summary_by_model(spark, sf_dir):
    return task_summary(run_log(spark, sf_dir), by=("model_key",))


@query(
    "g8_failure_top10",
    f"with {RUN_LOG} select substr(coalesce(error, 'Unknown error'), 1, 100) as reason, count(*) as failure_count "
    "from run_log where status = 'failed' group by 1 order by failure_count desc, reason limit 10",
)
def g8_failure_top10(spark, sf_dir):
    return failure_top(run_log(spark, sf_dir).filter(F.col("status") == "failed"))


@query(
    "g9_failure_head",
    f"with {RUN_LOG} select id, year, model_key, error from run_log where status = 'failed' "
    "order by id, year, model_key limit 10",
)
def g9_failure_head(spark, sf_dir):
    failed = run_log(spark, sf_dir).filter(F.col("status") == "failed")
    return failure_head(failed).select("id", "year", "model_key", "error")


@query("g10_model_keys", f"with {LINE_TASKS} select distinct model_key from line_tasks")
def g10_model_keys(spark, sf_dir):
    return model_keys(line_tasks(spark, sf_dir))
