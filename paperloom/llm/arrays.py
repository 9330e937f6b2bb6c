"""Texts of an Arrow batch as flat byte arrays, and hashes of their parts.

The functions here are small numpy helpers that run inside Spark tasks. A batch is cut
into chunks of about ``CHUNK_BYTES``, so a task holds a fixed amount besides its batch;
a longer text is a chunk by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_TEXTS = 4000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    """``base`` to the powers 0, 1, ... modulo 2**64, kept between calls."""
    if name not in _powers or len(_powers[name]) < size:
        steps = np.full(max(size, CHUNK_BYTES + 2), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts (one more entry at the end).

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(starts: np.ndarray, size: int = CHUNK_BYTES, texts: int = CHUNK_TEXTS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together have about ``size`` bytes."""
    at, end = 0, len(starts) - 1
    while at < end:
        to = int(np.searchsorted(starts, starts[at] + size, side="right")) - 1
        to = min(max(to, at + 1), at + texts, end)
        yield at, to
        at = to


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums from which ``span_hash`` gets the hash of any span."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span ``[begin, end)``; equal bytes give equal hashes."""
    raw = (sums[end] - sums[begin]) * _power("down", _BASE_INVERSE, len(sums))[begin]
    return mix(raw + (end - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~_SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[starts] = True
    before = np.concatenate(([False], inside[:-1]))
    begin = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, A-Z in lower case."""
    data = lower(data)
    begin, end, text = words(data, starts)
    return span_hash(prefix_hash(data), begin, end), text


_PLACES = np.array(
    [0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2545F4914F6CDD1D], dtype=np.uint64
)
SHINGLE_WORDS = len(_PLACES)


def shingles(word: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """52-bit hash and text number of every run of five words.

    A text of one to four words has its whole sequence as its one shingle.
    """
    count = np.bincount(text, minlength=texts)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    n = len(word)
    total = np.zeros(max(n - SHINGLE_WORDS + 1, 0), dtype=np.uint64)
    for j, place in enumerate(_PLACES):
        total += word[j : j + len(total)] * place
    whole = text[: len(total)] == text[SHINGLE_WORDS - 1 :] if n >= SHINGLE_WORDS else np.zeros(0, bool)
    values, owners = [total[whole]], [text[: len(total)][whole]]
    for size in range(1, SHINGLE_WORDS):
        at = first[count == size]
        if len(at):
            part = np.full(len(at), size, dtype=np.uint64)
            for j in range(size):
                part += word[at + j] * _PLACES[j]
            values.append(part)
            owners.append(text[at])
    return mix(np.concatenate(values)) >> np.uint64(12), np.concatenate(owners)
