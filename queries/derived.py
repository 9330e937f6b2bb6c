"""Tables derived from the given ones, in Spark and in SQL.

``papers`` turns every document into one version of a paper: two versions share an id,
and titles, dates and vectors have the gaps real harvests have. ``orders`` and
``lineitem`` stand in for a paper table and its updates at volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.schema import ModelSpec

DIM = 64
MODELS = {
    "m1": ModelSpec("m1", "encoder-one", DIM),
    "m2": ModelSpec("m2", "encoder-two", DIM),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Columns of one paper version, from a document ``d``.
_VERSION = r"""concat('p', cast(d.doc_id div 2 as string)) as id, d.doc_id as seq,
          case when d.doc_id % 13 = 0 then null else split_part(d.text, '\n', 1) end as title,
          case when d.doc_id % 11 = 0 then null else d.text end as abstract,
          concat(d.lang, '.', d.source, ' ', d.lang) as categories_raw,
          case when d.doc_id % 5 = 0 then null
               else cast(date_add(date'2020-01-01', cast(d.doc_id % 1500 as int)) as string) end as updated,
          case when d.doc_id % 19 = 0 then null
               when d.doc_id % 17 = 0
                 then cast(date_add(date'2018-01-01', cast(d.doc_id * 7 % 2500 as int)) as string)
               else concat(cast(date_add(date'2018-01-01', cast(d.doc_id * 7 % 2500 as int)) as string),
                           'T00:00:00Z') end as created,
          d.source, d.lang"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, seq, title, abstract, categories_raw, updated, created, source, lang, m1``."""
    return spark.sql(
        f"""
        select {_VERSION},
          case when d.doc_id % 7 = 1 then transform(e.embedding, x -> float(0)) else e.embedding end as m1
        from {{documents}} d left join {{embeddings}} e on e.vec_id = d.doc_id
        """,
        documents=table(spark, sf_dir, "documents"),
        embeddings=table(spark, sf_dir, "embeddings"),
    )


def bare_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``papers`` without ``m1``; documents and vectors meet only if vectors repeat an id, and rows with it."""
    ids = table(spark, sf_dir, "embeddings").filter("vec_id is not null").groupBy("vec_id").count()
    if not ids.filter("count > 1").isEmpty():
        return papers(spark, sf_dir).drop("m1")
    return spark.sql(f"select {_VERSION} from {{documents}} d", documents=table(spark, sf_dir, "documents"))


PAPERS = r"""papers as (
  select 'p' || (d.doc_id // 2)::varchar as id, d.doc_id as seq,
    case when d.doc_id % 13 = 0 then null else split_part(d.text, chr(10), 1) end as title,
    case when d.doc_id % 11 = 0 then null else d.text end as abstract,
    d.lang || '.' || d.source || ' ' || d.lang as categories_raw,
    case when d.doc_id % 5 = 0 then null
         else strftime(date '2020-01-01' + (d.doc_id % 1500)::int, '%Y-%m-%d') end as updated,
    case when d.doc_id % 19 = 0 then null
         when d.doc_id % 17 = 0 then strftime(date '2018-01-01' + (d.doc_id * 7 % 2500)::int, '%Y-%m-%d')
         else strftime(date '2018-01-01' + (d.doc_id * 7 % 2500)::int, '%Y-%m-%d') || 'T00:00:00Z'
         end as created,
    d.source, d.lang,
    case when d.doc_id % 7 = 1 then list_transform(e.embedding, lambda x: 0::float) else e.embedding end as m1
  from documents d left join embeddings e on e.vec_id = d.doc_id
)"""

# Year of a stored date in either format, as SQL on column c.
SQL_YEAR = "year(coalesce(try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ'), try_strptime({c}, '%Y-%m-%d')))::int"

# Vector predicates as SQL on column c.
SQL_SUM = (
    "coalesce(list_sum(list_transform({c}, lambda x: x::double)), case when {c} is null then null else 0 end)"
)
SQL_NEAR_ZERO = "coalesce(abs(" + SQL_SUM + ") < 1e-7, false)"
SQL_NEEDS = "({c} is null or " + SQL_NEAR_ZERO + ")"


def with_papers(select: str, *ctes: str) -> str:
    return "with " + ", ".join([PAPERS, *ctes]) + " " + select


# --- a keyed paper table, its re-harvest, and its vectors ---------------------------

BOTH_YEAR = SQL_YEAR.format(c="created")


def paper_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with a year from either date format, latest version per (id, year)."""
    from paperloom.operators.dedup import latest
    from paperloom.operators.years import BOTH_FORMATS, split_valid, with_year

    valid, _ = split_valid(with_year(papers(spark, sf_dir), "created", BOTH_FORMATS))
    return latest(valid, ("id", "year"), tie=("seq",))


PAPER_TABLE = f"""paper_table as (
  select * exclude (rn) from (
    select *, row_number() over (partition by id, year order by updated desc nulls last, seq) as rn
    from (select *, {BOTH_YEAR} as year from papers) where year is not null)
  where rn = 1
)"""


def increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents harvested again: ids moved by 150, so some are new and some known."""
    return spark.sql(
        r"""
        select concat('p', cast(doc_id div 2 + 150 as string)) as id, doc_id as seq,
          split_part(text, '\n', 1) as title,
          case when doc_id % 4 = 0 then null
               else cast(date_add(date'2020-06-01', cast(doc_id * 3 % 1500 as int)) as string) end as updated,
          concat(cast(date_add(date'2018-01-01', cast(doc_id * 7 % 2500 as int)) as string), 'T00:00:00Z') as created,
          source
        from {documents}
        """,
        documents=table(spark, sf_dir, "documents"),
    )


INCREMENT = r"""increment as (
  select 'p' || (doc_id // 2 + 150)::varchar as id, doc_id as seq, split_part(text, chr(10), 1) as title,
    case when doc_id % 4 = 0 then null
         else strftime(date '2020-06-01' + (doc_id * 3 % 1500)::int, '%Y-%m-%d') end as updated,
    strftime(date '2018-01-01' + (doc_id * 7 % 2500)::int, '%Y-%m-%d') || 'T00:00:00Z' as created,
    source
  from documents
)"""


def vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long vectors of model m1 from all versions of all papers; German ones are NaN."""
    from pyspark.sql import functions as F

    from paperloom.functions.vectors import nan_vector, vector_sum
    from paperloom.operators.years import BOTH_FORMATS, split_valid, with_year

    rows, _ = split_valid(with_year(papers(spark, sf_dir), "created", BOTH_FORMATS))
    vector = F.when(F.col("lang") == "de", nan_vector(DIM)).otherwise(F.col("m1"))
    return rows.filter(F.col("m1").isNotNull()).select(
        "id", "year", F.lit("m1").alias("model_key"), vector.alias("vector"),
        vector_sum(vector).alias("vector_sum"), "seq",
    )


VECTOR_TABLE = f"""vector_table as (
  select id, year, 'm1' as model_key, seq,
    case when lang = 'de' then list_transform(m1, lambda x: 'nan'::float) else m1 end as vector
  from (select *, {BOTH_YEAR} as year from papers) where m1 is not null and year is not null
), vector_newest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by id, year, model_key order by seq desc) as rn from vector_table)
  where rn = 1
)"""


def wide_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paper table with a second model column that only some sources have."""
    from pyspark.sql import functions as F

    half = F.transform("m1", lambda x: x / 2)
    return paper_table(spark, sf_dir).withColumn(
        "m2", F.when(F.col("source").isin("src1", "src2", "src3"), half.cast("array<float>"))
    )


WIDE_PAPERS = """wide_papers as (
  select *, case when source in ('src1', 'src2', 'src3')
                 then list_transform(m1, lambda x: (x / 2)::float) end as m2
  from paper_table
)"""
