"""Texts over a stretch: each window lies in one stretch, and one that occurs once stays."""

import random

import numpy as np

from paperloom.llm.repeats import _PIECE, LENGTH, _pieces, repeated_spans


def test_each_window_in_one_stretch():
    for size in (_PIECE, _PIECE + 1, _PIECE + 5000, 3 * _PIECE - 2 * LENGTH + 2):
        times = np.zeros(size - LENGTH + 1, np.int64)
        for _, _, low, high in _pieces(np.zeros(size, np.uint8), np.array([0, size])):
            times[low : high - LENGTH + 1] += 1
        assert (times == 1).all()


def test_a_boundary_window_that_occurs_once_stays(spark):
    text = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz ", k=_PIECE + 5000))
    begin = _PIECE - LENGTH  # where the second stretch used to begin; all places its sample can have are shared
    shared = text[begin : begin + LENGTH - 1] + "#" * 5
    docs = spark.createDataFrame([(1, text), (2, shared), (3, "#" + text[begin + 1 : begin + LENGTH])], "doc_id long, text string")
    assert [r[2] for r in repeated_spans(docs).sort("doc_id").collect()] == [0, 0, 0]
