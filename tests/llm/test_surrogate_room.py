"""More distinct values than one draw has surrogates still get surrogates of their own kind."""

import re

import pytest
from pyspark.sql import functions as F

from paperloom.llm.surrogates import replace_entities


def names(count, letters):
    return ["".join((letters[k // 400 % 20].upper(), letters[k // 20 % 20], letters[k % 20], letters[3], letters[0])) for k in range(count)]


@pytest.mark.parametrize("title, letters, script", [("Mrs", "abcdefghijklmnopqrst", "[A-Z][a-z]+"), ("Herr", "абвгдежзийклмнопрсту", "[А-Я][а-я]+")])
def test_names_beyond_the_first_pool(spark, title, letters, script):
    real = names(1500, letters)
    table = spark.createDataFrame([(k, f"Dear {title} {n}, hello") for k, n in enumerate(real)], "doc_id long, text string")
    put = [re.fullmatch(rf"Dear {title} (.*), hello", r.text)[1] for r in replace_entities(table).collect()]
    assert len(set(put)) == len(real) and not set(put) & set(real)
    assert all(re.fullmatch(script, p) for p in put)


def test_short_mails_find_room(spark):
    real = [f"{a}@{b}.co" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrst"]
    table = spark.createDataFrame([(k, f"to {m} now") for k, m in enumerate(real)], "doc_id long, text string").repartition(2)
    put = [re.fullmatch(r"to (\S+) now", r.text)[1] for r in replace_entities(table).select(F.col("text")).collect()]
    assert len(set(put)) == len(real) and not set(put) & set(real)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", p) for p in put)
