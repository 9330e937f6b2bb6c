"""Token alignment against an alignment by plain sets of offsets, token by token."""

import hashlib
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import token_alignment as ta

TEXTS = [
    None, "", " ", "one two", "one two", "Hello, wörld! 中文 🙂", "<|endoftext|> <s> </s>", "a▁b", "a  b\n\n\tc  ", "x" * 5000, "=" * 777 + "-" * 333,
    "\x00\x01\x7f", "The quick brown fox isn't 12345 lazy.", "  leading", "Ünï cödé ß ﬁ ½ ㍿", "﻿bom", "é", "def f(x):\n    return x**2\n",
    "".join(chr(0x1F600 + k % 80) for k in range(600)),
]
SCHEMA = "doc_id long, text string, lang string, pair long, n long, chunk long, total long, place int"


@pytest.fixture(scope="module")
def tokenizers():
    return ta.ByteLevelTokens(ta.DEFAULT_BYTE_LEVEL), ta.PieceTokens(ta.DEFAULT_PIECES)


def plain(first, second, text):
    """Groups of a text as lists of ids."""
    if not text:
        return []
    whole = (" " + text).encode()
    a = first.exact.encode(" " + text, add_special_tokens=False).ids
    b = second.model.encode(text)
    if b"".join(first.bytes[i] for i in a) != whole or b"".join(second.bytes[i] for i in b) != whole:
        return []

    def ends(side, ids):
        at, out = 0, []
        for i in ids:
            at += len(side.bytes[i])
            out.append(at)
        return out

    end_a, end_b = ends(first, a), ends(second, b)
    groups, before = [], 0
    for cut in sorted(set(end_a) & set(end_b)):
        groups.append(([i for i, e in zip(a, end_a, strict=True) if before < e <= cut], [i for i, e in zip(b, end_b, strict=True) if before < e <= cut]))
        before = cut
    return groups


def expected(first, second, rows):
    groups = [plain(first, second, text) for _, text in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(pair for c in links for pair in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(n, top.get(x, 0))
    out = Counter()
    for (doc, _), g, c in zip(rows, groups, links, strict=True):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out[(
            doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in c.items()),
            hashlib.sha256(said.encode()).hexdigest() if g else "",
        )] += 1
    return out


def table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in SCHEMA.split(", ")[2:])])


def test_alignment_matches_plain_offsets(spark, tokenizers):
    rows = [*enumerate(TEXTS), (None, "one two three"), (3, "one two"), (None, None)]
    assert Counter(tuple(r) for r in ta.align_tokens(table(spark, rows)).collect()) == expected(*tokenizers, rows)
    assert ta.align_tokens(table(spark, rows).limit(0)).count() == 0


def test_alignment_of_a_table(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in ta.align_tokens(docs).collect()) == expected(*tokenizers, rows)


def test_large_groups_and_small_chunks_give_the_same(tokenizers, monkeypatch):
    first, second = tokenizers
    found = ta.align(first, second, TEXTS)
    before = ta.linked_pairs(found, len(second.bytes))
    monkeypatch.setattr(ta, "GROUP_LINKS", 1)
    after = ta.linked_pairs(found, len(second.bytes))
    assert all((x == y).all() for x, y in zip(before, after, strict=True))


def test_fast_ids_are_the_file_s(tokenizers):
    first, _ = tokenizers
    assert first.fast is not None
    random.seed(7)
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["".join(random.choice("ab 1'st\n") + c for c in every[k : k + 500]) for k in range(0, len(every), 500)]
    texts += ["".join(random.choices("abAB  \n\t'sd12_.#é中", k=300)) for _ in range(300)] + [" " * 20_000 + "x", "\n" * 12_000]
    slow = [e.ids for e in first.exact.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert first.encode(texts) == slow
