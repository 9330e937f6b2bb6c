"""The corpus operators on small tables: edge rows, and brute force where SQL has no form."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm.decontaminate import best_distance, drop_leaks, find_leaks
from paperloom.llm.exact_dedup import drop_exact_copies, exact_groups
from paperloom.llm.html_text import extract_text, main_text
from paperloom.llm.language_id import identify, keep_identified
from paperloom.llm.mixing import bisect_alpha, mix_sources
from paperloom.llm.near_dedup import near_duplicates
from paperloom.llm.repeats import repeated_spans
from paperloom.llm.suffix_tree_lm import score_texts
from paperloom.llm.surrogates import replace_entities
from paperloom.llm.token_counts import Counter as TokenCounter
from paperloom.llm.token_counts import Vocabulary, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, key string"
WORDS = [f"w{k % 97}x{k * k % 89}" for k in range(700)]


def body(begin, size, changed=()):
    return " ".join(f"new{k}" if k in changed else WORDS[begin + k] for k in range(size))


def rows():
    long = body(0, 120)
    texts = [
        None, "", " \n\t ", "one two", "one two", long, long, body(0, 120, (60,)), body(0, 120, (5, 50, 90, 110)), body(300, 80),
        "x" * 1000, body(200, 100) + " " + body(0, 100), "Ünï cödé ß " * 60, "a b c d e", "A B C D E",
    ]
    out = [(k, t, None if k == 3 else "en" if k % 2 else "de", None if k == 4 else f"s{k % 3}", None, "l", "k") for k, t in enumerate(texts)]
    return [*out, (None, "no id here at all", "en", "s0", 1, None, None), (9, body(300, 80), "en", "s0", 1, "l", "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(docs, empty):
    got = [tuple(r)[:4] for r in exact_groups(docs).collect()]
    weak = [tuple(r)[:4] for r in exact_groups(docs, F.lit("same digest")).collect()]
    groups = {}
    for row in rows():
        groups.setdefault(row[1] or "", []).append(row[0])
    assert len(got) == len(rows()) and Counter(got) == Counter(weak)
    for ids in groups.values():
        mine = [g for g in got if g[0] in ids]
        known = [i for i in ids if i is not None]
        assert all(g[1] == (max(known) if known else None) and g[2] == len(ids) for g in mine)
        assert sum(g[3] for g in mine) == 1
    assert exact_groups(empty).count() == 0
    assert drop_exact_copies(docs).columns == docs.columns


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def test_near_duplicates(docs, empty):
    sets = {r[0]: shingle_set(r[1]) for r in rows() if r[0] is not None}
    label = {d: d for d in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows())
    assert {(r[0], r[1], r[2]) for r in got if r[0] is not None} == {(d, len(s), label[d]) for d, s in sets.items()}
    assert near_duplicates(empty).count() == 0


def test_repeated_spans(docs, empty):
    raw = [(r[0], (r[1] or "").encode()) for r in rows()]
    seen = Counter(b[i : i + 400] for _, b in raw for i in range(len(b) - 399))
    expected = []
    for doc, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        expected.append((doc, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    assert Counter(tuple(r)[:5] for r in repeated_spans(docs).collect()) == Counter(expected)
    assert repeated_spans(empty).count() == 0


def test_leaks(spark, docs, empty):
    item = body(300, 40)
    edited = item[:50] + "?" + item[51:]
    bench = spark.createDataFrame([(1, item), (2, edited), (3, None), (4, "too short"), (5, body(500, 40))], "item_id long, text string")
    got = {tuple(r) for r in find_leaks(docs, bench).collect()}
    assert got == {(9, 1, 0), (9, 2, 1)}
    assert drop_leaks(docs, bench).count() == len(rows()) - 2
    assert find_leaks(empty, bench).count() == 0 and find_leaks(docs, bench.limit(0)).count() == 0


def test_edit_distance_matches_the_table():
    for pattern, text in (("kitten", "the sitting cat"), ("abc", "xxabxcxx"), ("aaaa", "bbbb")):
        row = [0] * (len(text) + 1)
        for i, p in enumerate(pattern, 1):
            new = [i]
            for j, t in enumerate(text, 1):
                new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
            row = new
        masks = {}
        for k, c in enumerate(pattern):
            masks[c] = masks.get(c, 0) | 1 << k
        assert best_distance(masks, len(pattern), text, len(pattern))[0] == min(row)


def test_mixing(docs, empty):
    assert bisect_alpha([100, 100], 200, max_repeats=1.0) == 0.0
    alpha = bisect_alpha([900, 100], 1000, max_repeats=2.0)
    assert 0 < alpha < 1
    got = mix_sources(docs, budget=2000, max_repeats=1.5)
    assert got.filter("copy < 0").count() == 0 and got.groupBy("source").count().count() == 4
    assert mix_sources(empty).count() == 0


def test_language(docs, empty):
    got = identify(docs).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (0, 1, 2))
    assert keep_identified(docs).columns == docs.columns
    assert identify(empty).count() == 0


def test_scores(docs, empty):
    got = {r.doc_id: r for r in score_texts(docs).collect()}
    assert got[0].n_tokens == 1 and got[3].n_tokens == 3 and got[5].n_tokens == 121
    assert all(r.score < 0 and r.base_score < 0 for r in got.values())
    assert score_texts(empty).count() == 0


def test_surrogates(spark, empty):
    text = "write Ann.Lee@site.org or ann.lee@site.org, call +1 (988) 555-2485 from 10.1.2.3, card 4041 8949 7460 8795. Dear Mrs Jones"
    table = spark.createDataFrame([(1, text), (2, text), (3, "nothing 12 here"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in replace_entities(table).collect()}
    assert got[1].text == got[2].text and got[1].n_entities == 6
    mails = re.findall(r"\S+@\S+?(?=[ ,])", got[1].text)
    assert mails[0].lower() == mails[1].lower() and "lee" not in got[1].text and "Jones" not in got[1].text
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1].text) and "8795" not in got[1].text
    assert got[3].text == "nothing 12 here" and got[4].text is None and got[5].text == ""
    assert replace_entities(empty).count() == 0


def test_token_counts(docs, empty):
    models = pytest.importorskip("tokenizers.models")
    from tokenizers import Tokenizer

    vocabulary = Vocabulary.load("/opt/tokenizers/piece_bpe_32k.model")
    exact = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary.pieces.items()], 0, False))
    plain = TokenCounter(Vocabulary(vocabulary.pieces, False))
    for text in ("one two", "a  b\nc", "Ünï cödé 中🙂", body(0, 50)):
        assert plain.count(text) == len(exact.encode("▁" + text.replace(" ", "▁")).ids)
    assert {r.n_tokens for r in token_counts(docs).collect() if r.doc_id in (0, 1)} == {0}
    assert token_counts(empty).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>t</title></head><body><nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad'>Buy now</div>"
        "<article><h1>Title &amp; more</h1><p>First  paragraph\nof the text.<p>Second<br>one.</article>"
        "<div class='comments'><p>A reader says a lot of words here.</p></div><footer>&copy; site</footer>"
    )
    assert main_text(page) == "Title & more\nFirst paragraph of the text.\nSecond one."
    table = spark.createDataFrame([(1, None, page), (2, "u", None), (3, "u", ""), (None, "u", "<p")], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars for r in extract_text(table).collect()} == {1: len(main_text(page)), 2: 0, 3: 0, None: 0}
