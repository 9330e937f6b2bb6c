"""The filter audit against a plain walk through all orders, and its SQL."""

import re
from collections import Counter
from itertools import permutations

import oracle
from pyspark.sql import functions as F

from paperloom.llm import queries
from paperloom.llm.filter_audit import audit_filters

SCHEMA = "doc_id long, text string, source string, mask int, n long, part string, good int, same string"
PROSE = " ".join(f"word{k}" for k in range(60))


def rows():
    texts = [
        None, "", " \n ", PROSE, PROSE, PROSE + " #", "A B C D E", "a b " * 40, PROSE.upper(), PROSE.upper(), "x" * 50_000, "*", "é" * 200,
        "Ünï cödé " * 30, PROSE + " 100%", PROSE + " z",
    ]
    out = [(10 + k, t, None if k in (1, 4) else f"s{k % 3}") for k, t in enumerate(texts)]
    # No id, one row twice, one id with two texts, an empty source, and a smaller id for a text seen above.
    return [*out, (None, PROSE, "s0"), (None, PROSE, "s0"), (14, PROSE, None), (20, "two", "s1"), (20, "three", "s1"), (30, "a", ""), (3, "*", "s9")]


LABELS = [(13, 1, 0), (14, 1, 1), (14, 0, 1), (15, 0, 1), (16, None, 1), (17, 1, None), (None, 1, 1), (999, 1, 1)]


def expected():
    docs, out = rows(), {}
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    good = {d for d, q, _ in LABELS if q == 1 and d is not None}
    toxic = {d for d, _, t in LABELS if t == 1 and d is not None}

    def fails(doc, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and least[text] < doc,
        }

    judged = [(doc, source or "", fails(doc, text)) for doc, text, source in docs]
    total = Counter()
    for part in {p for _, p, _ in judged}:
        mine = [(d, f) for d, p, f in judged if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                here = [(d, f) for d, f in left if f[x]]
                left = [(d, f) for d, f in left if not f[x]]
                total[part, x] += len(here)
                out[part, "".join(order), step] = (
                    len(left), len(here), sum(f[x] for _, f in mine) - len(here),
                    sum(f[x] and sum(f.values()) == 1 for _, f in mine), sum(d in good for d, _ in here), sum(d in toxic for d, _ in here),
                )
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_matches_a_walk_through_all_orders(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string").repartition(3)
    docs = docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in SCHEMA.split(", ")[3:])])
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit_filters(docs, labels).collect()}
    assert got == expected()


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit_filters(docs.limit(0), labels).count() == 0
    bare = audit_filters(docs, labels.limit(0))
    assert bare.filter("good_lost + toxic_lost > 0").count() == 0 and bare.count() == 5 * 600


def test_audit_matches_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_filter_audit"](spark, sf_dir)
    assert oracle.differences(got, oracle.connect(sf_dir), queries.ORACLE["op11_filter_audit"]) == []
