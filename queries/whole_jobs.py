"""Jobs and readers as a user calls them, over files that Spark lands first."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.operators.embed import hash_encoder
from paperloom.operators.years import with_year
from paperloom.plans import backlog_and_split, embed_whole, upsert_years
from paperloom.schema import registry
from paperloom.session import shared_dir
from paperloom.sinks.tables import write_years
from paperloom.sources.tables import read_artifacts, read_task_array, read_tasks, read_vectors, read_years
from paperloom.versions import create_table
from queries import query
from queries.derived import DIM, MODELS, PAPER_TABLE, VECTOR_TABLE, paper_table, papers, table, vector_table, with_papers
from queries.splits import BACKLOG
from queries.tables_io import ORDER_TABLE, order_table
from queries.vectors import SQL_BYTE_SUM, SQL_BYTES, SQL_TEXT, _bytes, finite_sum, sql_finite_sum


@query(
    "s7_read_artifacts",
    with_papers(
        f"select id, year, model_key, 3 as seq, {sql_finite_sum('vector')} as total from vector_newest", VECTOR_TABLE
    ),
)
def s7_read_artifacts(spark, sf_dir):
    """Artifact files of one work list, named by year and model; a model that has no file is asked for too."""
    from paperloom.operators.dedup import latest

    root = shared_dir(spark, "q-artifacts")
    newest = latest(vector_table(spark, sf_dir), ("id", "year", "model_key"), "seq").withColumnRenamed("vector", "m1")
    for row in newest.select("year").distinct().collect():  # at most the calendar years of the table
        newest.filter(F.col("year") == row[0]).select("id", "m1").write.parquet(f"{root}/matrix-output-3/embedded-{row[0]}.parquet-m1.parquet")
    rows = read_artifacts(spark, root, ["m1", "m2"])
    return rows.select("id", "year", "model_key", F.col("seq").cast("int").alias("seq"), finite_sum("vector").alias("total"))


@query(
    "s8_task_array",
    with_papers("select id, year, model_key from backlog", PAPER_TABLE, VECTOR_TABLE, BACKLOG),
)
def s8_task_array(spark, sf_dir):
    """Externally made task files, each one JSON array over several lines."""
    from paperloom.operators.backlog import backlog

    root = shared_dir(spark, "q-task-arrays")
    tasks = backlog(paper_table(spark, sf_dir), vector_table(spark, sf_dir), MODELS)
    entry = F.to_json(F.struct("id", F.concat("year", F.lit(".parquet")).alias("year_file"), "model_key"))
    lists = tasks.groupBy(F.pmod(F.xxhash64("id", "year"), F.lit(50)).alias("list")).agg(F.collect_list(entry).alias("entries"))
    text = F.concat(F.lit("[\n"), F.array_join("entries", ",\n"), F.lit("\n]")).alias("value")
    lists.select("list", text).write.partitionBy("list").text(root)
    return read_task_array(spark, f"{root}/list=*")


@query(
    "s9_registry",
    "select source as model_key, case when count(*) % 2 = 0 then 'encoder of ' || source end as name, "
    "case when max(n_chars) % 3 <> 0 then count(*)::int end as dimension from documents where source is not null group by source",
)
def s9_registry(spark, sf_dir):
    """A configuration made from the sources, as a list of tables, read as the model registry."""
    docs = table(spark, sf_dir, "documents").filter("source is not null")
    rows = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("most")).collect()
    config = [
        {r.source: ({"model_name": f"encoder of {r.source}"} if r.n % 2 == 0 else {}) | ({"dimension": r.n} if r.most % 3 else {})} for r in rows
    ]
    specs = registry(config + [{"title": "not a model"}])
    return spark.createDataFrame([(s.key, s.name, s.dimension) for s in specs.values()], "model_key string, name string, dimension int")


@query(
    "k3_empty_write",
    f"with {ORDER_TABLE} select 'skip' as on_empty, count(*) as n, 0 as written from order_table union all select 'write', 0, 0",
)
def k3_empty_write(spark, sf_dir):
    """A harvest without rows leaves the table as it is, or an empty one that has its schema."""
    out = None
    for how in ("skip", "write"):
        root, orders = shared_dir(spark, f"q-empty-{how}"), order_table(spark, sf_dir)
        write_years(orders, root)
        written = write_years(orders.filter("id = 'none'"), root, on_empty=how)
        counts = read_years(spark, root).agg(F.lit(how).alias("on_empty"), F.count("amount").alias("n"), F.lit(written).alias("written"))
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    "x4_moved_years",
    with_papers(
        "select id, max(year)::int as year, 1 as copies from (select id, seq, year(try_strptime(created, '%Y-%m-%dT%H:%M:%SZ'))::int "
        "+ case when seq % 2 = 1 and seq % 3 = 0 then 1 else 0 end as year, row_number() over (partition by id order by seq desc) as rn "
        "from papers where try_strptime(created, '%Y-%m-%dT%H:%M:%SZ') is not null) where rn = 1 group by id"
    ),
)
def x4_moved_years(spark, sf_dir):
    """Second versions correct the year of first versions: every paper ends in one year."""
    rows = papers(spark, sf_dir).select("id", "seq", "created", "title")
    later = (F.col("seq") % 2 == 1) & (F.col("seq") % 3 == 0)
    year = F.substring("created", 1, 4).cast("int") + F.when(later, 1).otherwise(0)
    rows = rows.withColumn("created", F.concat(year.cast("string"), F.substring("created", 5, 30)))
    # A leap day moved by a year is none; the query is about years.
    rows = rows.withColumn("created", F.regexp_replace("created", "-02-29T", "-02-28T"))
    root = shared_dir(spark, "q-moved")
    create_table(spark, root, with_year(rows, 2024).schema, 8)
    for part in (0, 1):
        upsert_years(spark, rows.filter(F.col("seq") % 2 == part), root, arrival=("seq",), move=True)
    return read_years(spark, root).groupBy("id").agg(F.max("year").alias("year"), F.count(F.lit(1)).cast("int").alias("copies"))


@query(
    "x6_written_lists",
    with_papers("select id, year, model_key from backlog", PAPER_TABLE, VECTOR_TABLE, BACKLOG),
)
def x6_written_lists(spark, sf_dir):
    """The job that writes the work lists; all lists together are the backlog."""
    output = shared_dir(spark, "q-lists")
    backlog_and_split(paper_table(spark, sf_dir), vector_table(spark, sf_dir), MODELS, output)
    return read_tasks(spark, output).select("id", "year", "model_key")


@query(
    "x9_embed_whole",
    with_papers(
        f"select id, year, seq, {SQL_BYTES}, {SQL_BYTE_SUM} as byte_sum from (select p.id, p.year, p.seq, {SQL_TEXT} from paper_table p)",
        PAPER_TABLE,
    ),
)
def x9_embed_whole(spark, sf_dir):
    """Every row of a table embedded and written with its columns."""
    output = shared_dir(spark, "q-whole")
    embed_whole(paper_table(spark, sf_dir).select("id", "year", "seq", "title", "abstract"), hash_encoder(DIM), "m1", DIM, output)
    return spark.read.parquet(output).select("id", "year", "seq", *_bytes(F.col("m1")))
