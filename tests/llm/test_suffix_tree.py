"""The suffix tree against one that is built state by state, and its gain over the base score."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from paperloom.llm.suffix_tree_lm import Settings, score_texts

END = None


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


def brute(rows, settings):
    texts = [(doc, tokens(text), zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 != 2) for doc, text in rows]
    learnt = [t for _, t, learns in texts if learns]
    count = Counter(x for t in learnt for x in t)
    total, vocabulary = sum(count.values()), len(count)
    following = defaultdict(Counter)
    for t in learnt:
        for i in range(len(t)):
            for d in range(1, min(settings.depth, i) + 1):
                following[tuple(t[i - d : i])][t[i]] += 1

    def root(x):
        return (count[x] + 1) / (total + vocabulary + 1)

    kept = {}

    def probability(state, x):
        while state and not kept.get(state):
            state = state[1:]
        if not state:
            return root(x)
        own = following[state]
        return (own[x] + len(own) * probability(state[1:], x)) / (sum(own.values()) + len(own))

    for state in sorted(following, key=len):
        own = following[state]
        n, kinds = sum(own.values()), len(own)
        # Each occurrence is predicted from all the others; a symbol seen once keeps only the suffix's share.
        gained = sum(
            math.log(kinds / (n + kinds)) if m == 1 else m * (math.log((m - 1) / (n + kinds)) - math.log(probability(state[1:], x)))
            for x, m in own.items()
        )
        often = n >= settings.min_count and all(count[w] >= settings.min_count for w in state[:1])
        kept[state] = often and gained >= settings.min_divergence
    out = []
    for doc, t, learns in texts:
        score = sum(math.log10(probability(tuple(t[max(0, i - settings.depth) : i]), x)) for i, x in enumerate(t))
        base = sum(math.log10(root(x)) for x in t)
        out.append((doc, not learns, len(t), sum(x in count for x in t), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str), sum(kept.values())


def texts():
    rhyme = "the cat sat on the mat and the dog sat on the log"
    out = [(k, f"{rhyme} {'and then the cat ran' if k % 3 else 'but the dog slept'} number{k}") for k in range(40)]
    out += [(50, None), (51, ""), (52, " \n\t"), (None, "the cat sat"), (None, None), (7, out[7][1]), (60, "unseen words only"), (61, "Über MAT " * 30)]
    return out


@pytest.mark.parametrize(
    "settings", [Settings(), Settings(min_count=2, chunk_texts=3, share=4), Settings(depth=3, min_count=3, min_divergence=-5.0, chunk_texts=7, share=10)]
)
def test_scores_match_a_tree_built_state_by_state(spark, settings):
    table = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    table = table.selectExpr("*", "'en' as lang", "1 as chunk", "2 as bucket", "3 as state", "4 as depth", "5 as ids")
    got = sorted(((*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in score_texts(table, settings).collect()), key=str)
    expected, states = brute(texts(), settings)
    assert states > 3
    assert got == expected


def test_scores_of_odd_tables(spark):
    table = spark.createDataFrame(texts(), "doc_id long, text string")
    assert score_texts(table.limit(0)).count() == 0
    only = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    held = spark.createDataFrame([(k, "a b") for k in only], "doc_id long, text string")
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in score_texts(held).collect()} == {(3, 0, 0, 0.0, 0.0)}


@pytest.mark.parametrize("scale, least", [("sf0.01", 0.2), ("sf0.1", 0.4)])
def test_held_out_texts_are_scored_better_than_by_the_base(spark, scale, least):
    rows = score_texts(spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")).filter("held_out")
    rows = rows.selectExpr("sum(score) as s", "sum(base_score) as b", "sum(n_tokens) as n", "avg(cast(score > base_score as int)) as better").first()
    assert (rows.s - rows.b) / rows.n > least and rows.better > 0.75
