"""Stages of the pipeline decide on rows: repeated rows, one id with two texts, rows without id."""

from collections import Counter

from paperloom.llm.decontaminate import drop_leaks
from paperloom.llm.exact_dedup import drop_exact_copies
from paperloom.llm.near_dedup import keep_one_of_each, near_duplicates

SCHEMA = "doc_id long, text string"
A, B, C, D = (" ".join(f"{name}{k * k % 61}x{k}" for k in range(60)) for name in "abcd")
NEAR_A = A + " end"


def kept(frame):
    assert frame.columns == ["doc_id", "text"]
    return Counter(tuple(r) for r in frame.collect())


def test_exact_copies_go_by_row(spark):
    docs = spark.createDataFrame([(1, A), (1, A), (2, A), (3, B), (3, B), (4, C), (4, A), (None, A), (None, D), (None, D), (None, C)], SCHEMA)
    assert kept(drop_exact_copies(docs)) == Counter([(4, A), (3, B), (4, C), (None, D)])
    two = spark.createDataFrame([(1, A), (1, B), (2, B)], SCHEMA)  # (1, B) goes although (1, A) stays
    assert kept(drop_exact_copies(two)) == Counter([(1, A), (2, B)])


def test_near_copies_go_by_row(spark):
    docs = spark.createDataFrame([(1, B), (1, B), (2, A), (2, C), (3, NEAR_A), (4, C + " end"), (None, D), (None, D), (None, NEAR_A)], SCHEMA)
    assert kept(keep_one_of_each(docs)) == Counter([(1, B), (2, A), (2, C), (None, D)])
    labels = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert labels == Counter([(1, 1), (1, 1), (2, 2), (2, 2), (3, 2), (4, 2), (None, None), (None, None), (None, None)])


def test_leaks_go_by_row(spark):
    docs = spark.createDataFrame([(1, A), (1, B), (None, A), (None, C), (2, D), (2, D)], SCHEMA)
    bench = spark.createDataFrame([(7, A[20:120])], "item_id long, text string")
    assert kept(drop_leaks(docs, bench)) == Counter([(1, B), (None, C), (2, D), (2, D)])
