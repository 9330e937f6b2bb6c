"""Benchmark items of few words are looked for too, in any script."""

from paperloom.llm.decontaminate import Matcher, find_leaks

HAN = "床前明月光疑是地上霜举头望明月低头思故乡春眠不觉晓处处闻啼鸟"
EDITED = HAN[:10] + "水" + HAN[11:]


def test_short_and_unspaced_items(spark):
    docs = spark.createDataFrame([
        (1, f"他说{EDITED}。"), (2, "Who wrote Faust? Goethe."), (3, "concatenate"), (4, "A cat, sleeping"), (5, "我的东京塔很高"), (6, None), (7, ""), (8, "ภาษาไทยง่าย"),
    ], "doc_id long, text string")
    bench = spark.createDataFrame(
        [(1, HAN), (2, "who wrote  Faust?"), (3, "cat"), (4, "东京塔"), (5, " "), (6, None), (7, "ไทย"), (8, "goethe")], "item_id long, text string"
    )
    assert sorted(tuple(r) for r in find_leaks(docs, bench).collect()) == [(1, 1, 1), (2, 2, 0), (2, 8, 0), (4, 3, 0), (5, 4, 0), (8, 7, 0)]


def test_word_boundaries():
    matcher = Matcher([(1, "art"), (2, "?!")], 0.08)
    assert list(matcher.search("start artful")) == [] and list(matcher.search("start an art show")) == [(1, 0)]
    assert list(matcher.search("what?!no")) == [(2, 0)]
