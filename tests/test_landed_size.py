"""Pages landed without a join and compressed, and read back."""

import gzip
import os

from paperloom.plans.harvest import checked_records
from paperloom.sources.oai import page_envelope, page_records, read_envelope, read_oai, read_pages
from pyspark.sql import functions as F
from queries.derived import bare_papers, papers
from queries.landing import land_pages
from test_sources import _page, _record, pages  # noqa: F401
from test_whole_pages import _rows


def _tables(spark, root, vec_ids):
    text = F.concat(F.lit("Title "), "doc_id", F.lit("\n"), F.repeat(F.lit("some words of a text "), 200))
    docs = spark.range(60).select(
        F.when(F.col("id") != 7, F.col("id")).alias("doc_id"), F.lit("en").alias("lang"),
        F.concat(F.lit("src"), F.col("id") % 4).alias("source"),
    )
    docs.withColumn("text", text).write.parquet(f"{root}/documents.parquet")
    vectors = spark.createDataFrame([(v, [1.0, 2.0]) for v in vec_ids], "vec_id long, embedding array<float>")
    vectors.write.parquet(f"{root}/embeddings.parquet")
    return root


def test_compressed_pages_are_read_like_plain_ones(spark, pages, folder):  # noqa: F811
    packed = folder("packed")
    for at, _, names in os.walk(pages):
        for name in names:
            to = os.path.join(packed, os.path.relpath(at, pages))
            os.makedirs(to, exist_ok=True)
            with open(os.path.join(at, name), "rb") as plain, gzip.open(os.path.join(to, name + ".gz"), "wb") as out:
                out.write(plain.read())
    plain = folder("plain")
    _page(plain, "z.xml", _record("z"))
    for path in (packed, [packed, plain]):
        whole = read_pages(spark, path)
        assert _rows(page_records(whole)) == _rows(read_oai(spark, path))
        assert _rows(page_envelope(whole)) == _rows(read_envelope(spark, path))
    assert read_pages(spark, packed).filter("corrupt").isEmpty()
    assert _rows(checked_records(spark, packed).drop("page")) == _rows(checked_records(spark, pages).drop("page"))


def test_landed_pages_are_compressed(spark, folder):
    root = _tables(spark, folder(), range(60))
    landed = land_pages(spark, root, trailers=False).removeprefix("file:")
    files = [os.path.join(at, n) for at, _, names in os.walk(landed) for n in names if n.startswith("part-")]
    text = spark.read.parquet(f"{root}/documents.parquet").agg(F.sum(F.length("text"))).first()[0]
    assert files and 0 < sum(map(os.path.getsize, files)) < text / 5
    assert read_oai(spark, landed).count() == 60


def test_papers_without_vectors_need_no_join(spark, folder):
    once = _tables(spark, folder(), [*range(40), None, None])
    text = bare_papers(spark, once)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text
    twice = _tables(spark, folder(), [*range(40), 3, 3, 5, None, None])
    for root in (once, twice):
        assert _rows(bare_papers(spark, root)) == _rows(papers(spark, root).drop("m1"))
    assert bare_papers(spark, twice).count() == 63
