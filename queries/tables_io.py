"""Writers read back, year selection, and artifact and task files."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.split import split_tasks
from paperloom.operators.years import select_years
from paperloom.plans import merge_artifacts
from paperloom.session import shared_dir
from paperloom.sinks.tables import replace_years, write_artifacts, write_status, write_tasks, write_years
from paperloom.sources.tables import artifact_model, artifact_year, read_tasks, read_years
from queries import query
from queries.derived import PAPER_TABLE, VECTOR_TABLE, paper_table, table, vector_table, with_papers
from queries.joins_reports import RUN_LOG, SUMMARY, run_log
from queries.splits import ORDER_TASKS, line_tasks, order_tasks, sql_split, LINE_TASKS
from queries.vectors import OVERLAY_SQL, artifacts, finite_sum, sql_finite_sum


def order_table(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").alias("amount"),
        F.year("o_orderdate").alias("year"),
    )


ORDER_TABLE = (
    "order_table as (select o_orderkey::varchar as id, o_totalprice as amount, year(o_orderdate)::int as year from orders)"
)


@query("k1_year_write", f"with {ORDER_TABLE} select * from order_table")
def k1_year_write(spark, sf_dir):
    root = shared_dir(spark, "q-years")
    write_years(order_table(spark, sf_dir), root)
    return read_years(spark, root)


@query(
    "k2_replace_year",
    f"with {ORDER_TABLE} select id, case when year in (1996, 1998) then -amount else amount end as amount, year "
    "from order_table",
)
def k2_replace_year(spark, sf_dir):
    """Two years are rewritten from the very table they replace; the others stay."""
    root = shared_dir(spark, "q-replace")
    write_years(order_table(spark, sf_dir), root)
    changed = read_years(spark, root, [1996, 1998]).withColumn("amount", -F.col("amount"))
    replace_years(changed, root)
    return read_years(spark, root)


@query("s6_year_select", f"with {ORDER_TABLE} select * from order_table where contains(year::varchar, '199') or year = 2001")
def s6_year_select(spark, sf_dir):
    root = shared_dir(spark, "q-select")
    write_years(order_table(spark, sf_dir), root)
    return select_years(read_years(spark, root), "199, 2001")


@query("s6_year_exact", f"with {ORDER_TABLE} select * from order_table where year in (1997, 2000)")
def s6_year_exact(spark, sf_dir):
    root = shared_dir(spark, "q-exact")
    write_years(order_table(spark, sf_dir), root)
    return select_years(read_years(spark, root), "1997, 2000", exact=True)


@query(
    "s10_all_years",
    with_papers("select id, year, seq, title, abstract from paper_table", PAPER_TABLE),
)
def s10_all_years(spark, sf_dir):
    root = shared_dir(spark, "q-all")
    write_years(paper_table(spark, sf_dir), root)
    return read_years(spark, root).select("id", "year", "seq", "title", "abstract")


@query(
    "s7_artifact_meta",
    with_papers("select year, model_key, count(*) as vector_count from vector_table group by all", VECTOR_TABLE),
)
def s7_artifact_meta(spark, sf_dir):
    """Year and model of each artifact, taken from the name it is stored under."""
    root = shared_dir(spark, "q-names")
    name = F.format_string("embedded-%d.parquet-%s.parquet", "year", "model_key")
    vectors = vector_table(spark, sf_dir).withColumn("artifact", name)
    vectors.select("id", "vector", "artifact").write.partitionBy("artifact").parquet(root)
    path = F.col("_metadata.file_path")
    stored = spark.read.schema("id string, vector array<float>").parquet(root)
    named = stored.select(artifact_year(path).alias("year"), artifact_model(path).alias("model_key"))
    return named.groupBy("year", "model_key").agg(F.count(F.lit(1)).alias("vector_count"))


@query(
    "k4_artifact_write",
    with_papers(
        f"select id, year, model_key, seq, {sql_finite_sum('vector')} as vector_sum, len(vector) as size from vector_table",
        VECTOR_TABLE,
    ),
)
def k4_artifact_write(spark, sf_dir):
    root = shared_dir(spark, "q-artifacts")
    write_artifacts(vector_table(spark, sf_dir), root)
    stored = spark.read.parquet(root)
    return stored.select(
        "id", "year", "model_key", "seq", finite_sum("vector").alias("vector_sum"),
        F.size("vector").cast("bigint").alias("size"),
    )


@query("k5_task_write", f"with {LINE_TASKS}, {sql_split('line_tasks')} select id, year, model_key, matrix_id from assigned")
def k5_task_write(spark, sf_dir):
    root = shared_dir(spark, "q-tasks")
    write_tasks(split_tasks(line_tasks(spark, sf_dir)), root)
    return spark.read.schema("id string, year int, model_key string, matrix_id int").json(root)


@query(
    "s8_task_scan",
    f"with {ORDER_TASKS}, {sql_split('order_tasks')} select id, year, model_key from assigned where matrix_id = 3",
)
def s8_task_scan(spark, sf_dir):
    root = shared_dir(spark, "q-scan")
    write_tasks(split_tasks(order_tasks(spark, sf_dir), unique=True), root)
    return read_tasks(spark, root, matrix_id=3)


@query(
    "k6_status_write",
    f"with {RUN_LOG} select id, year, model_key, status, error from run_log",
)
def k6_status_write(spark, sf_dir):
    root = shared_dir(spark, "q-status")
    write_status(run_log(spark, sf_dir), root)
    schema = "id string, year int, model_key string, error string, status string"
    return spark.read.schema(schema).json(f"{root}/tasks")


@query("k6_summary_write", f"with {RUN_LOG} select {SUMMARY} from run_log")
def k6_summary_write(spark, sf_dir):
    root = shared_dir(spark, "q-summary")
    write_status(run_log(spark, sf_dir), root)
    schema = "attempted bigint, succeeded bigint, failed bigint, success_percent double, any_failed boolean"
    return spark.read.schema(schema).json(f"{root}/summary")


@query("x8_merge_artifacts", OVERLAY_SQL)
def x8_merge_artifacts(spark, sf_dir):
    """The whole job on a stored wide table."""
    root = shared_dir(spark, "q-overlay")
    write_years(paper_table(spark, sf_dir).select("id", "year", "seq", "title", "m1"), root)
    merge_artifacts(spark, root, artifacts(spark, sf_dir), ["m1", "m2"])
    merged = read_years(spark, root)
    return merged.select("id", "year", "seq", finite_sum("m1").alias("m1_sum"), finite_sum("m2").alias("m2_sum"))
