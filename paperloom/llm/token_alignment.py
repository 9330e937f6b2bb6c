"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Two tokenizers cut the same bytes in two ways. Tokens that overlap belong together, and
so do chains of them: a group ends where tokens of both end. Groups are found by pointer
jumping: every token points to its farthest-right overlapping token of the other side,
or to itself if it reaches as far, and all successors of a chunk of texts are doubled at
once until they stand still at each group's last token, which labels the group.

A chunk of texts sends each linked id pair once, with the number of its texts that hold
it; Spark adds the pairs up, marks the pairs that are their first id's most frequent, and
sends the sums back to the chunks. Nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.arrays import chunks, text_bytes
from paperloom.session import cut_lineage

DEFAULT_BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_PIECES = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 2 << 20
#: Token pairs of a group that are written out singly; larger groups are counted by their different ids.
GROUP_LINKS = 4_096
# Fixed value: how byte-level vocabularies of this kind cut text before merging.
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space this long overflows the fast encoder's pattern matching.
_LONG_SPACE = re.compile(r"\s{10000}")


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if visible, else the next from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteLevelTokens:
    """Ids of space and text under a byte-level vocabulary file, special tokens read as plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        letters, vocabulary = _byte_letters(), form["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        self.fast = self._ranked(form)

    def _ranked(self, form: dict):
        """A faster encoder of the same ids, if the file's merges come in the order of the ids they make."""
        import tiktoken

        model, cutting = form["model"], form["pre_tokenizer"] or {}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"].get("".join(m), -1) for m in pairs]
        plain = cutting.get("type") == "ByteLevel" and cutting.get("use_regex") and not cutting.get("add_prefix_space")
        single = sorted(set(range(len(self.bytes))) - set(made))
        alike = form["normalizer"] is None and not model.get("ignore_merges") and not model.get("dropout")
        if not (plain and alike and made == sorted(set(made)) and [len(self.bytes[k]) for k in single] == [1] * 256):
            return None
        if single[-1] > made[0]:
            return None
        return tiktoken.Encoding("byte-level", pat_str=_CUTS, mergeable_ranks={b: k for k, b in enumerate(self.bytes)}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for text in texts:
            if self.fast is None or len(text) >= 10_000 and _LONG_SPACE.search(text):
                out.append(self.exact.encode(" " + text, add_special_tokens=False).ids)
            else:
                out.append(self.fast.encode_ordinary(" " + text))
        return out


class PieceTokens:
    """Ids of text under a piece model, which puts a space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in ((k, self.model.id_to_piece(k)) for k in range(self.model.get_piece_size()))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


_loaded: dict[tuple[str, str], object] = {}


def _tokenizer(kind: type, path: str):
    """A tokenizer, loaded once by a Python worker."""
    if (kind.__name__, path) not in _loaded:
        _loaded[kind.__name__, path] = kind(path)
    return _loaded[kind.__name__, path]


def jump(size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token of both sides, from the tokens' sizes in bytes; both sides cover the same bytes."""
    n = len(size_a)
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    # Tokens touch without gaps: the last one that starts before an end is the farthest that overlaps.
    far_b = np.searchsorted(end_b - size_b, end_a, "left") - 1
    far_a = np.searchsorted(end_a - size_a, end_b, "left") - 1
    own = np.arange(n)
    following = np.concatenate((np.where(end_b[far_b] > end_a, n + far_b, own) if n else own, far_a))
    while True:
        twice = following[following]
        if np.array_equal(twice, following):
            break
        following = twice
    last = np.flatnonzero(following[:n] == own)
    return np.searchsorted(last, following[:n]), np.searchsorted(last, following[n:])


@dataclass
class Alignment:
    """Texts of a chunk, laid end to end: ids, group of each token, and what each text has of them."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    text_of_group: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


def align(first: ByteLevelTokens, second: PieceTokens, texts: list[str | None]) -> Alignment:
    """Tokens and groups of texts; those that are null or empty or whose bytes do not come back have none."""
    said = [k for k, text in enumerate(texts) if text]
    a_ids, b_ids = first.encode([texts[k] for k in said]), second.encode([texts[k] for k in said])
    n_a, n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    kept_a, kept_b = [], []
    for k, a, b in zip(said, a_ids, b_ids, strict=True):
        whole = b" " + texts[k].encode()
        if b"".join([first.bytes[i] for i in a]) == whole and b"".join([second.bytes[i] for i in b]) == whole:
            kept_a.append(a)
            kept_b.append(b)
            n_a[k], n_b[k] = len(a), len(b)
    a = np.fromiter(chain.from_iterable(kept_a), np.int64, int(n_a.sum()))
    b = np.fromiter(chain.from_iterable(kept_b), np.int64, int(n_b.sum()))
    sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (first, second)]
    group_a, group_b = jump(sizes[0][a], sizes[1][b])
    owner = np.repeat(np.arange(len(texts)), n_a)
    starts = np.flatnonzero(np.diff(group_a, prepend=-1))
    return Alignment(a, b, group_a, group_b, owner[starts], n_a, n_b)


def group_digests(found: Alignment, first: ByteLevelTokens, second: PieceTokens) -> list[str]:
    """SHA-256 of each text's groups written as ``a1,a2|b1;a3|b2,b3``; empty for texts without tokens."""
    endings = (b",", b"|", b";")
    last_a = np.diff(found.group_a, append=-1) != 0
    last_b = np.diff(found.group_b, append=-1) != 0
    n_groups = len(found.text_of_group)
    before_a = np.concatenate(([0], np.cumsum(np.bincount(found.group_a, minlength=n_groups))))
    before_b = np.concatenate(([0], np.cumsum(np.bincount(found.group_b, minlength=n_groups))))
    place_a = np.arange(len(found.a)) + before_b[found.group_a]
    place_b = np.arange(len(found.b)) + before_a[found.group_b + 1]
    code = np.empty(len(found.a) + len(found.b), np.int64)
    code[place_a] = found.a * 3 + last_a
    code[place_b] = found.b * 3 + last_b * 2
    used, word = np.unique(code, return_inverse=True)
    words = [b"%d%s" % (c // 3, endings[c % 3]) for c in used.tolist()]
    out, at = [], 0
    for size in (found.n_a + found.n_b).tolist():
        said = b"".join([words[w] for w in word[at : at + size].tolist()])
        out.append(hashlib.sha256(said[:-1]).hexdigest() if size else "")
        at += size
    return out


def linked_pairs(found: Alignment, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, pair ``a * pieces + b`` and links of every pair that a text holds, and the links of each text."""
    n_groups, texts = len(found.text_of_group), len(found.n_a)
    size_a, size_b = (np.bincount(g, minlength=n_groups) for g in (found.group_a, found.group_b))
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    links = size_a * size_b
    per_text = np.bincount(found.text_of_group, links, minlength=texts).astype(np.int64)
    small = np.flatnonzero(links <= GROUP_LINKS)
    group = np.repeat(small, links[small])
    within = np.arange(len(group)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
    pair = found.a[start_a[group] + within // size_b[group]] * pieces + found.b[start_b[group] + within % size_b[group]]
    span = int(found.a.max(initial=0) + 1) * pieces
    keys, times = np.unique(found.text_of_group[group] * span + pair, return_counts=True)
    parts = [(keys, times)]
    for g in np.flatnonzero(links > GROUP_LINKS):
        a, many_a = np.unique(found.a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
        b, many_b = np.unique(found.b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
        parts.append(((found.text_of_group[g] * span + a[:, None] * pieces + b[None, :]).ravel(), np.outer(many_a, many_b).ravel()))
    if len(parts) > 1:
        keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, place, np.concatenate([p[1] for p in parts]))
        times = totals
    return keys // span, keys % span, times, per_text


_ROW = (
    "chunk long, place int, pair long, n long, ids binary, known binary, sizes binary, digests string, "
    "texts binary, places binary, times binary"
)


def _aligned(byte_level: str, piece_model: str):
    """A row for each pair of a chunk of texts, and one for the chunk itself (its ``pair`` is null)."""
    kinds = {"chunk": pa.int64(), "place": pa.int32(), "pair": pa.int64(), "n": pa.int64(), "digests": pa.string()}
    names = [c.split()[0] for c in _ROW.split(", ")]

    def batch_of(size: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[n], kinds.get(n, pa.binary())) if n in columns else pa.nulls(size, kinds.get(n, pa.binary())) for n in names], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _tokenizer(ByteLevelTokens, byte_level), _tokenizer(PieceTokens, piece_model)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text")
            ids = batch.column("doc_id")
            _, starts = text_bytes(texts)
            for begin, end in chunks(starts, CHUNK_BYTES):
                found = align(first, second, texts.slice(begin, end - begin).to_pylist())
                text, pair, times, links = linked_pairs(found, len(second.bytes))
                pairs, place, n = np.unique(pair, return_inverse=True, return_counts=True)
                part = ids.slice(begin, end - begin)
                sizes = np.stack((found.n_a, found.n_b, np.bincount(found.text_of_group, minlength=end - begin), links))
                yield batch_of(1, {
                    "chunk": [number], "ids": [part.fill_null(0).to_numpy().astype(np.int64).tobytes()],
                    "known": [np.asarray(part.is_valid()).astype(np.uint8).tobytes()], "sizes": [sizes.astype(np.int64).tobytes()],
                    "digests": [",".join(group_digests(found, first, second))], "texts": [text.astype(np.uint16).tobytes()],
                    "places": [place.astype(np.uint32).tobytes()], "times": [times.astype(np.int64).tobytes()],
                })
                if len(pairs):
                    yield batch_of(len(pairs), {
                        "chunk": np.full(len(pairs), number), "place": np.arange(len(pairs), dtype=np.int32), "pair": pairs, "n": n,
                    })
                number += 1

    return run


def _summed(_, chunk: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
    """The texts of a chunk, with the corpus-wide counts of their pairs."""
    row = chunk.iloc[0]
    ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], np.uint8)
    sizes = np.frombuffer(row["sizes"], np.int64).reshape(4, -1)
    text, place, times = (np.frombuffer(row[c], k) for c, k in (("texts", np.uint16), ("places", np.uint32), ("times", np.int64)))
    order = np.argsort(sums["place"].to_numpy())
    total, best = sums["total"].to_numpy()[order], sums["best"].to_numpy()[order].astype(bool)
    n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    np.add.at(n_best, text, times * best[place])
    np.add.at(count_sum, text, times * total[place])
    return pd.DataFrame({
        "doc_id": pd.array([i if k else None for i, k in zip(ids.tolist(), known, strict=True)], dtype="Int64"),
        "n_a": sizes[0], "n_b": sizes[1], "n_groups": sizes[2], "n_links": sizes[3], "n_best": n_best, "count_sum": count_sum,
        "groups_sha256": row["digests"].split(","),
    })


def align_tokens(docs: DataFrame, byte_level: str = DEFAULT_BYTE_LEVEL, piece_model: str = DEFAULT_PIECES) -> DataFrame:
    """Groups and links of two tokenizers for each row of ``docs``.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. The
    first tokenizer reads space and text, the second puts the space in front itself. Texts
    that are null or empty, or whose tokens do not give back exactly these bytes, have no
    tokens: zeros and an empty digest. Links are all pairs of tokens of one group; the count
    of an id pair is the number of rows that hold it linked, so repeated rows count each.
    Null ids pass through, an empty table gives no rows, other columns are ignored. Both
    files must be readable on every executor.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = cut_lineage(source.mapInArrow(_aligned(byte_level, piece_model), _ROW), "alignment")
    pairs = rows.filter("pair is not null").select("chunk", "place", "pair", "n")
    pieces = len(PieceTokens(piece_model).bytes)
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    # An id has at most as many pairs as the other vocabulary has pieces.
    own = Window.partitionBy(F.expr(f"pair div {pieces}"))
    marked = totals.withColumn("best", F.col("total") == F.max("total").over(own))
    sums = pairs.select("chunk", "place", "pair").join(marked, "pair").select(F.col("chunk").alias("of"), "place", "total", "best")
    parts = rows.filter("pair is null").drop("place", "pair", "n")
    return parts.groupBy("chunk").cogroup(sums.groupBy("of")).applyInPandas(
        _summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
