"""Stages keep every column of the caller, whatever its name; leaks against a plain distance table."""

import pytest

from paperloom.llm.decontaminate import ERROR_RATE, drop_leaks, find_leaks, normalised, stands_alone
from paperloom.llm.exact_dedup import drop_exact_copies
from paperloom.llm.language_id import keep_identified
from paperloom.llm.near_dedup import keep_one_of_each

NAMES = ["_row", "_copy", "_text", "_letters", "score", "lang_pred", "ambiguous", "held_out", "rep", "label", "digest", "locator", "keep_id", "kept", "item_id"]
WORDS = " ".join(f"some{k} words{k * 7 % 31} of a text" for k in range(40))


def table(spark, repeated):
    rows = [(k, f"{WORDS} number {k} " + "x y z " * k if k % 4 else WORDS, "en" if k % 2 else "de", f"s{k}", 5) for k in range(12)]
    rows += [(3, rows[3][1], "en", "s3", 5), (None, "no id but a text of some words", "en", None, 5)] if repeated else []
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *[f"cast(doc_id * 10 + {n} as int) as {c}" for n, c in enumerate(NAMES)])


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_of_the_caller_stay(spark, repeated):
    docs = table(spark, repeated)
    bench = spark.createDataFrame([(1, "number 5 x y z x y z x y z")], "item_id int, text string")
    whole = {str(r) for r in docs.collect()}
    for stage in (keep_identified, drop_exact_copies, keep_one_of_each, lambda d: drop_leaks(d, bench)):
        out = stage(docs)
        rows = [str(r) for r in out.collect()]
        assert out.columns == docs.columns and rows and set(rows) <= whole
    left = {r.doc_id for r in drop_leaks(docs, bench).collect()}
    assert 5 not in left and {0, 4, 8} <= left  # the others differ from the item by one figure


@pytest.mark.parametrize("kind", ["int", "long", "string", "smallint"])
def test_items_of_any_id_type(spark, kind):
    docs = table(spark, False).select("doc_id", "text")
    bench = spark.sql(f"select cast(id as {kind}) as item_id, text from values (1, 'number 5 x y'), (2, 'nothing of this kind at all') as t(id, text)")
    got = find_leaks(docs, bench)
    assert {(r.doc_id, str(r.item_id), r.distance) for r in got.collect()} >= {(5, "1", 0)} and got.schema["item_id"].dataType == bench.schema["item_id"].dataType
    small = find_leaks(docs, bench, block_chars=5)
    assert sorted(map(str, small.collect())) == sorted(map(str, got.collect()))


def least(item, text):
    """Least edit distance of ``item`` to any part of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_match_a_distance_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, normalised(r.text)[:400]) for r in docs.collect()][:40]
    items = [(k, text[20 + k : 20 + k + size]) for k, ((_, text), size) in enumerate(zip(rows, [5, 9, 12, 13, 14, 20, 26, 40, 60] * 3, strict=False)) if len(text) > 120]
    items += [(100 + k, t[: len(t) // 2] + "#" + t[len(t) // 2 + 1 :]) for k, t in items if len(t) > 12] + [(200, "de"), (201, "zz"), (202, "")]
    table_ = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = set()
    for item_id, raw in items:
        item = normalised(raw)
        most = int(len(item) * ERROR_RATE)
        for doc_id, text in rows:
            if not item:
                continue
            if most:
                distance = least(item, text)
                if distance <= most:
                    expected.add((doc_id, item_id, distance))
            elif any(text.startswith(item, k) and stands_alone(text, k, k + len(item)) for k in range(len(text))):
                expected.add((doc_id, item_id, 0))
    assert len(expected) > 30 and {tuple(r) for r in find_leaks(table_, bench).collect()} == expected
