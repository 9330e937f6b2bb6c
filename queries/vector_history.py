"""Vector histories kept as runs: newest rows, compaction, and encoding runs with a ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.backlog import backlog
from paperloom.operators.embed import hash_encoder
from paperloom.plans import merge_history, run_ledgered
from paperloom.session import shared_dir
from paperloom.sinks.tables import replace_years
from paperloom.sources.tables import read_vectors, read_years
from paperloom.vector_runs import append_run, compact, create_runs, live_runs, newest_rows
from paperloom.versions import create_table
from queries import query
from queries.derived import DIM, MODELS, PAPER_TABLE, VECTOR_TABLE, paper_table, vector_table, with_papers
from queries.joins_reports import run_log
from queries.runs import CTES
from queries.splits import BACKLOG, order_tasks
from queries.vectors import SQL_BYTES, SQL_BYTE_SUM, SQL_TEXT, _bytes, _sql_backlog, finite_sum, sql_finite_sum

NEWEST = with_papers(
    f"select id, year, model_key, {sql_finite_sum('vector')} as total from vector_newest where year is not null", VECTOR_TABLE
)


def _history(spark, sf_dir):
    """Vectors of first and of second versions as two runs."""
    root, vectors = shared_dir(spark, "q-runs"), vector_table(spark, sf_dir)
    create_runs(spark, root)
    for part in (0, 1):
        append_run(vectors.filter(F.col("seq") % 2 == part), root)
    return root


def _totals(rows):
    return rows.select("id", "year", "model_key", finite_sum("vector").alias("total"))


@query("j7_newest_rows", NEWEST)
def j7_newest_rows(spark, sf_dir):
    """The newest row of each paper and model, chosen by narrow columns and fetched by file and row."""
    return _totals(newest_rows(spark, _history(spark, sf_dir)))


@query("k4_compacted", NEWEST)
def k4_compacted(spark, sf_dir):
    """The same rows from the one run that compaction leaves."""
    root = _history(spark, sf_dir)
    compact(spark, root)
    if len(live_runs(spark, root)[1]) != 1:
        raise RuntimeError("compaction leaves one run")
    return _totals(read_vectors(spark, root))


@query(
    "x8_merge_history",
    with_papers(
        f"select p.id, p.year, p.seq, {sql_finite_sum('v.vector')} as total from paper_table p "
        "left join vector_newest v on v.id = p.id and v.year = p.year",
        PAPER_TABLE, VECTOR_TABLE,
    ),
)
def x8_merge_history(spark, sf_dir):
    """The newest vectors of a history overlaid on a versioned table."""
    root, vectors_root = shared_dir(spark, "q-history-table"), _history(spark, sf_dir)
    rows = paper_table(spark, sf_dir).select("id", "year", "seq")
    create_table(spark, root, rows.schema, 8)
    replace_years(rows, root)
    merge_history(spark, root, vectors_root, ["m1", "m2"])
    return read_years(spark, root).select("id", "year", "seq", finite_sum("m1").alias("total"))


@query("p20_compacted_backlog", _sql_backlog(False))
def p20_compacted_backlog(spark, sf_dir):
    root = _history(spark, sf_dir)
    compact(spark, root)
    return backlog(paper_table(spark, sf_dir), read_vectors(spark, root), MODELS)


def _resumed(spark, sf_dir):
    """A run whose first call knows an encoder of one model only; the second goes on with the other."""
    papers, root = paper_table(spark, sf_dir), shared_dir(spark, "q-ledger")
    create_runs(spark, root)
    tasks = (
        backlog(papers, vector_table(spark, sf_dir), MODELS)
        .union(order_tasks(spark, sf_dir).withColumn("model_key", F.lit("m1")))
        .union(run_log(spark, sf_dir).select("id", "year", F.lit("m3")))
    )
    run_ledgered(papers, tasks, MODELS, {"m1": hash_encoder(DIM)}, root, "r-query", slices=2)
    encoders = {key: hash_encoder(DIM) for key in MODELS}
    return run_ledgered(papers, tasks, MODELS, encoders, root, "r-query", slices=2)


@query(
    "x7_resumed_status",
    with_papers(
        "select id, year, model_key, case when error is null then 'processed' else 'failed' end as status, error from ("
        "select t.id, t.year, t.model_key, case when t.model_key = 'm3' then 'no configuration for model m3' "
        "when p.id is null then 'id is not in the table for this year' end as error "
        "from tasks t left join paper_table p on p.id = t.id and p.year = t.year)",
        *CTES,
    ),
)
def x7_resumed_status(spark, sf_dir):
    return _resumed(spark, sf_dir).status.select("id", "year", "model_key", "status", "error")


@query(
    "x7_resumed_vectors",
    with_papers(
        f"select id, year, model_key, {SQL_BYTES}, {SQL_BYTE_SUM} as byte_sum from (select b.id, b.year, b.model_key, "
        f"{SQL_TEXT} from backlog b join paper_table p on p.id = b.id and p.year = b.year)",
        PAPER_TABLE, VECTOR_TABLE, BACKLOG,
    ),
)
def x7_resumed_vectors(spark, sf_dir):
    return _resumed(spark, sf_dir).vectors.select("id", "year", "model_key", *_bytes(F.col("vector")))
