"""Vector state, repair, embedding and overlay."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.text import embed_text
from paperloom.functions.vectors import (
    any_nonzero,
    cast_vector,
    is_near_zero,
    repair,
    vector_sum,
)
from paperloom.operators.align import add_missing, replace_column
from paperloom.operators.backlog import backlog, backlog_wide, potential_tasks, state_counts
from paperloom.operators.embed import embed, embed_table, hash_encoder
from paperloom.operators.overlay import add_vector, overlay, update_vector, wide_view
from paperloom.operators.status import sample_finished
from paperloom.schema import yearly_schema
from queries import query
from queries.derived import (
    DIM,
    MODELS,
    PAPER_TABLE,
    SQL_NEAR_ZERO,
    SQL_NEEDS,
    SQL_SUM,
    VECTOR_TABLE,
    WIDE_PAPERS,
    paper_table,
    papers,
    table,
    vector_table,
    wide_papers,
    with_papers,
)


def rounded(total):
    """A sum rounded so that the order of additions does not show; never -0."""
    return F.round(total, 4) + F.lit(0.0)


def sql_rounded(vector: str) -> str:
    return f"round({SQL_SUM.format(c=vector)}, 4) + 0.0"


@query("p15_vector_sum", f"select vec_id, {sql_rounded('embedding')} as vector_sum from embeddings")
def p15_vector_sum(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", rounded(vector_sum("embedding")).alias("vector_sum"))


@query(
    "p17_near_zero",
    with_papers(f"select seq, {SQL_NEAR_ZERO.format(c='m1')} as near_zero, m1 is null as absent from papers"),
)
def p17_near_zero(spark, sf_dir):
    return papers(spark, sf_dir).select(
        "seq", is_near_zero("m1").alias("near_zero"), F.col("m1").isNull().alias("absent")
    )


@query(
    "p18_any_nonzero",
    with_papers(
        f"select id, year, seq from wide_papers where {SQL_SUM.format(c='m1')} <> 0 or {SQL_SUM.format(c='m2')} <> 0",
        PAPER_TABLE, WIDE_PAPERS,
    ),
)
def p18_any_nonzero(spark, sf_dir):
    return wide_papers(spark, sf_dir).filter(any_nonzero(["m1", "m2"])).select("id", "year", "seq")


@query(
    "p19_preview",
    with_papers(
        "select id, array_to_string(list_transform(m1[1:5], lambda x: round(x::double * 10000)::bigint::varchar), '|') as preview, "
        f"{sql_rounded('m1')} as vector_sum from paper_table where not {SQL_NEEDS.format(c='m1')} "
        "order by md5('42|' || id), id limit 5",
        PAPER_TABLE,
    ),
)
def p19_preview(spark, sf_dir):
    sample = sample_finished(paper_table(spark, sf_dir), "m1", n=5)
    text = F.transform("preview", lambda x: F.round(x.cast("double") * 10000).cast("bigint").cast("string"))
    return sample.select("id", F.array_join(text, "|").alias("preview"), rounded(F.col("vector_sum")).alias("vector_sum"))


def _sql_backlog(retry_nan: bool) -> str:
    needs = SQL_NEEDS.format(c="v.vector")
    if retry_nan:
        needs = f"({needs} or coalesce(isnan({SQL_SUM.format(c='v.vector')}), false))"
    return with_papers(
        "select p.id, p.year, 'm1' as model_key from paper_table p left join vector_newest v "
        f"on v.id = p.id and v.year = p.year where {needs} "
        "union all select id, year, 'm2' from paper_table",
        PAPER_TABLE, VECTOR_TABLE,
    )


@query("p20_backlog", _sql_backlog(False))
def p20_backlog(spark, sf_dir):
    return backlog(paper_table(spark, sf_dir), vector_table(spark, sf_dir), MODELS)


@query("p20_backlog_retry_nan", _sql_backlog(True))
def p20_backlog_retry_nan(spark, sf_dir):
    return backlog(paper_table(spark, sf_dir), vector_table(spark, sf_dir), MODELS, retry_nan=True)


@query(
    "p20_backlog_wide",
    with_papers(
        f"select id, year, 'm1' as model_key from wide_papers where {SQL_NEEDS.format(c='m1')} "
        f"union all select id, year, 'm2' from wide_papers where {SQL_NEEDS.format(c='m2')}",
        PAPER_TABLE, WIDE_PAPERS,
    ),
)
def p20_backlog_wide(spark, sf_dir):
    return backlog_wide(wide_papers(spark, sf_dir), MODELS)


@query("g3_potential_tasks", with_papers("select count(*) * 2 as potential_tasks from paper_table", PAPER_TABLE))
def g3_potential_tasks(spark, sf_dir):
    return potential_tasks(paper_table(spark, sf_dir), MODELS)


@query(
    "g4_vector_state_counts",
    with_papers(
        " union all ".join(
            f"select year, '{m}' as model_key, count(*) as row_count, count(*) filter ({m} is null) as null_count, "
            f"count(*) filter ({SQL_NEAR_ZERO.format(c=m)}) as near_zero_count from wide_papers group by year"
            for m in ("m1", "m2")
        ),
        PAPER_TABLE, WIDE_PAPERS,
    ),
)
def g4_vector_state_counts(spark, sf_dir):
    return state_counts(wide_papers(spark, sf_dir), MODELS)


# The hash encoder gives bytes of the text's MD5 digest, so SQL can follow it exactly.
SQL_BYTE = "('0x' || substr(md5(text), {at}, 2))::int"
SQL_BYTES = ", ".join(f"{SQL_BYTE.format(at=2 * k + 1)} as b{k}" for k in range(3))
SQL_BYTE_SUM = "(" + " + ".join(SQL_BYTE.format(at=2 * k + 1) for k in range(16)) + ") * 4"
SQL_TEXT = "coalesce(title, '') || chr(10) || coalesce(abstract, '') as text"


def _bytes(vector):
    scaled = F.transform(vector, lambda x: F.round(x * 255).cast("int"))
    total = F.aggregate(scaled, F.lit(0), lambda acc, x: acc + x)
    return [scaled[k].alias(f"b{k}") for k in range(3)] + [total.alias("byte_sum")]


@query(
    "e1_embed",
    with_papers(
        f"select seq, {DIM} as size, {SQL_BYTES}, {SQL_BYTE_SUM} as byte_sum from (select seq, {SQL_TEXT} from papers)"
    ),
)
def e1_embed(spark, sf_dir):
    texts = papers(spark, sf_dir).select("seq", embed_text().alias("text"))
    done = embed(texts, hash_encoder(DIM), DIM, keys=["seq"], partitions=spark.sparkContext.defaultParallelism)
    return done.select("seq", F.size("vector").alias("size"), *_bytes(F.col("vector")))


@query(
    "e5_embed_table",
    with_papers(
        f"select id, seq, title, updated, {SQL_BYTES}, {SQL_BYTE_SUM} as byte_sum "
        f"from (select id, seq, title, updated, {SQL_TEXT} from papers)"
    ),
)
def e5_embed_table(spark, sf_dir):
    done = embed_table(
        papers(spark, sf_dir), hash_encoder(DIM), "m1", DIM, partitions=spark.sparkContext.defaultParallelism
    )
    return done.select("id", "seq", "title", "updated", *_bytes(F.col("m1")))


RAW = """case when label = 1 then embedding[1:10] when label = 2 then [] when label = 3 then null else embedding end"""


def _raw_vector():
    return (
        F.when(F.col("label") == 1, F.slice("embedding", 1, 10))
        .when(F.col("label") == 2, F.array().cast("array<float>"))
        .when(F.col("label") != 3, F.col("embedding"))
    )


@query(
    "e2_repair",
    f"select vec_id, {DIM} as size, case when len(v) = {DIM} then 0 else {DIM} end as nan_count, "
    f"case when len(v) = {DIM} then {sql_rounded('v')} end as vector_sum "
    f"from (select vec_id, {RAW} as v from embeddings)",
)
def e2_repair(spark, sf_dir):
    fixed = table(spark, sf_dir, "embeddings").select("vec_id", repair(_raw_vector(), DIM).alias("v"))
    return fixed.select(
        "vec_id",
        F.size("v").alias("size"),
        F.size(F.filter("v", F.isnan)).alias("nan_count"),
        rounded(F.nullif(vector_sum("v"), F.lit(float("nan")))).alias("vector_sum"),
    )


@query(
    "e3_replace_column",
    with_papers("select id, seq, updated, (length(coalesce(abstract, '')) + 1)::double as m1_first from papers"),
)
def e3_replace_column(spark, sf_dir):
    vector = F.array((F.length(F.coalesce("abstract", F.lit(""))) + 1).cast("float"))
    replaced = replace_column(papers(spark, sf_dir), "m1", vector)
    return replaced.select("id", "seq", "updated", F.col("m1")[0].cast("double").alias("m1_first"))


@query(
    "a1_null_fill",
    with_papers("select id, seq, title, null::varchar as license, null::int as author_count from papers"),
)
def a1_null_fill(spark, sf_dir):
    rows = papers(spark, sf_dir)
    seq = rows.select("seq").schema[0]
    schema = yearly_schema()
    filled = add_missing(rows, type(schema)([*schema.fields, seq]))
    authors = F.when(F.col("authors").isNotNull(), F.size("authors"))
    return filled.select("id", "seq", "title", "license", authors.alias("author_count"))


@query(
    "a2_zero_fill",
    with_papers(
        "select p.id, p.year, p.seq, coalesce(len(v.vector), 64) as m1_size, "
        f"coalesce({sql_rounded('v.vector')}, 0) as m1_sum, 64 as m2_size, 0.0::double as m2_sum "
        "from paper_table p left join vector_newest v on v.id = p.id and v.year = p.year",
        PAPER_TABLE, VECTOR_TABLE,
    ),
)
def a2_zero_fill(spark, sf_dir):
    wide = wide_view(paper_table(spark, sf_dir), vector_table(spark, sf_dir), MODELS, fill="zero")
    return wide.select(
        "id", "year", "seq",
        F.size("m1").cast("bigint").alias("m1_size"), rounded(vector_sum("m1")).alias("m1_sum"),
        F.size("m2").alias("m2_size"), vector_sum("m2").alias("m2_sum"),
    )


@query(
    "a3_cast_vectors",
    "select vec_id, len(v) as size, " + sql_rounded("v") + " as vector_sum from (select vec_id, "
    "list_transform(embedding, lambda x: (x::double / 3)::float) as v from embeddings)",
)
def a3_cast_vectors(spark, sf_dir):
    doubles = F.transform("embedding", lambda x: x.cast("double") / 3)
    cast = table(spark, sf_dir, "embeddings").select("vec_id", cast_vector(doubles, DIM).alias("v"))
    return cast.select("vec_id", F.size("v").cast("bigint").alias("size"), rounded(vector_sum("v")).alias("vector_sum"))


def _artifact(spark, sf_dir):
    """One artifact: the newest vectors of the papers of a few sources, halved."""
    rows = paper_table(spark, sf_dir)
    half = F.transform("m1", lambda x: x / 2).cast("array<float>")
    return rows.filter(F.col("source") > "src3").select("id", "year", half.alias("vector"))


ARTIFACT = """artifact as (
  select id, year, list_transform(m1, lambda x: (x / 2)::float) as vector from paper_table where source > 'src3'
)"""


@query(
    "j2_add_vector",
    with_papers(
        f"select p.id, p.year, {sql_rounded('p.m1')} as m1_sum, {sql_rounded('a.vector')} as m2_sum from paper_table p "
        "left join artifact a on a.id = p.id and a.year = p.year",
        PAPER_TABLE, ARTIFACT,
    ),
)
def j2_add_vector(spark, sf_dir):
    added = add_vector(paper_table(spark, sf_dir), _artifact(spark, sf_dir), "m2")
    return added.select(
        "id", "year", rounded(vector_sum("m1")).alias("m1_sum"), rounded(vector_sum("m2")).alias("m2_sum")
    )


@query(
    "j3_update_vector",
    with_papers(
        f"select id, year, {sql_rounded('v')} as m1_sum from (select p.id, p.year, coalesce(a.vector, p.m1) as v "
        "from paper_table p left join artifact a on a.id = p.id and a.year = p.year)",
        PAPER_TABLE, ARTIFACT,
    ),
)
def j3_update_vector(spark, sf_dir):
    changed = update_vector(paper_table(spark, sf_dir), _artifact(spark, sf_dir), "m1")
    return changed.select("id", "year", rounded(vector_sum("m1")).alias("m1_sum"))


def artifacts(spark, sf_dir):
    """Many artifacts: every version of every paper for m1, and halved ones for m2."""
    first = vector_table(spark, sf_dir).select("id", "year", "model_key", "vector", "seq")
    half = F.transform("vector", lambda x: x / 2).cast("array<float>")
    second = first.withColumns({"model_key": F.lit("m2"), "vector": half, "seq": -F.col("seq")})
    return first.unionByName(second)


ARTIFACTS = """artifacts as (
  select id, year, model_key, vector, seq from vector_table
  union all
  select id, year, 'm2', list_transform(vector, lambda x: (x / 2)::float), -seq from vector_table
), artifacts_last as (
  select id, year, model_key, arg_max(vector, seq) as vector from artifacts where vector is not null
  group by id, year, model_key
)"""


def sql_finite_sum(vector: str) -> str:
    return f"case when isnan({SQL_SUM.format(c=vector)}) then null else {sql_rounded(vector)} end"


def finite_sum(vector: str):
    return rounded(F.nullif(vector_sum(vector), F.lit(float("nan"))))


OVERLAY_SQL = with_papers(
    f"select id, year, seq, {sql_finite_sum('v1')} as m1_sum, {sql_finite_sum('v2')} as m2_sum from ("
    "select p.id, p.year, p.seq, coalesce(a.vector, p.m1) as v1, b.vector as v2 from paper_table p "
    "left join artifacts_last a on a.id = p.id and a.year = p.year and a.model_key = 'm1' "
    "left join artifacts_last b on b.id = p.id and b.year = p.year and b.model_key = 'm2')",
    PAPER_TABLE, VECTOR_TABLE, ARTIFACTS,
)


@query("j7_overlay", OVERLAY_SQL)
def j7_overlay(spark, sf_dir):
    merged = overlay(paper_table(spark, sf_dir), artifacts(spark, sf_dir), ["m1", "m2"])
    return merged.select("id", "year", "seq", finite_sum("m1").alias("m1_sum"), finite_sum("m2").alias("m2_sum"))
