"""Scoring texts with a probabilistic suffix tree over words.

A text is its words in lower case and one end. The tree's root predicts every symbol with
the smoothed frequencies of the base score; its other states are the last one or two
words. A state is kept if it was seen ``min_count`` times and its
next-symbol distribution diverges from its suffix's: each occurrence in the learning texts
is predicted from the others, and the log likelihood gained over the suffix must reach
``min_divergence``. A kept state smooths its counts towards its suffix's distribution, by
as much as it has seen different symbols; a symbol is scored in the longest kept state
that ends the text before it. The tree has no bound: it grows with the corpus, as a table
that is spread over tasks and never held by one of them or by the driver.

Texts are read once, in chunks that become word numbers. Then the tree grows a level at a
time. A chunk sends each of its different (state, next word) pairs once, with how often
its learning texts have it, to the pair's bucket; the bucket adds up what all chunks sent,
judges the states it holds and answers each chunk in the order of its pairs. So a chunk
learns only the part of the tree that its texts visit. States of very frequent words are
cut over several buckets by the word that follows, and judged from the buckets' sums.
A bucket holds one entry for each pair and chunk; there are as many buckets as keep them small.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrays import chunks, lower, mix, prefix_hash, span_hash, text_bytes, words
from paperloom.session import cut_lineage

BUCKET_BYTES = 12 << 20


@dataclass(frozen=True)
class Settings:
    """Parameters of the tree and of the chunks and buckets it is counted in."""

    #: Words of the longest states.
    depth: int = 2
    #: A state seen less often is not kept.
    min_count: int = 8
    #: Least gain in log likelihood over the suffix's distribution, in nats.
    min_divergence: float = 1.0
    #: Occurrences of a state for each bucket that its pairs are cut over.
    share: int = 1_000_000
    chunk_bytes: int = 3 << 20
    chunk_texts: int = 50_000


_END = np.uint64(0x9E3779B97F4A7C15)

_CHUNK = "bucket long, chunk long, words binary, counts binary, ids binary, flags binary, sizes binary, seq binary"
_PAIRS = "bucket long, chunk long, states binary, sizes binary, cut binary, follow binary, learnt binary, prior binary"
_ANSWER = (
    "chunk long, depth int, bucket long, totals binary, numbers binary, states binary, kinds binary, kept binary, "
    "vocabulary long, tokens long, state long, singles long, repeated long, n_kinds long, weight double"
)
_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _names(form: str) -> list[str]:
    return [part.split()[0] for part in form.split(", ")]


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, none below -1, in as few bytes as the greatest needs, bytes of one rank together and compressed."""
    up = (values.astype(np.int64) + 1).astype(np.uint64)
    most = int(up.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + _COMPRESSOR.compress(up.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(parts) -> np.ndarray:
    """The numbers of packed pieces, one after another."""
    out = [np.zeros(0, np.int64)]
    for part in parts:
        width = part[0]
        planes = np.frombuffer(_DECOMPRESSOR.decompress(part[1:]), np.uint8).reshape(width, -1)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64) - 1)
    return np.concatenate(out)


def symbols(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and end of the texts, in order, and how many each text has."""
    data = lower(data)
    begin, end, text = words(data, starts)
    sizes = np.bincount(text, minlength=len(starts) - 1) + 1
    out = np.empty(int(sizes.sum()), np.uint64)
    out[np.cumsum(sizes) - 1] = _END
    out[np.arange(len(begin)) + text] = span_hash(prefix_hash(data), begin, end)
    return out, sizes


def _chunked(buckets: int, settings: Settings):
    """A row for each chunk of texts, and its words with their learning counts for each bucket."""
    shift = np.uint64(64 - max(buckets.bit_length() - 1, 0))

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            ids, learns = batch.column("doc_id"), batch.column("learns").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in chunks(starts, settings.chunk_bytes, settings.chunk_texts):
                seq, sizes = symbols(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                known, seq = np.unique(seq, return_inverse=True)
                counts = np.bincount(seq[np.repeat(learns[a:b], sizes)], minlength=len(known))
                part = ids.slice(a, b - a)
                flags = np.stack((np.asarray(part.is_valid()).astype(np.uint8), learns[a:b].astype(np.uint8)))
                rows = [(-1, number, b"", b"", part.fill_null(0).to_numpy().astype(np.int64).tobytes(), flags.tobytes(),
                         pack(sizes), pack(seq))]
                bucket = (known >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(known), np.int64)
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                for x, y in zip(cut, [*cut[1:], len(known)], strict=True):
                    rows.append((int(bucket[x]), number, known[x:y].tobytes(), pack(counts[x:y]), b"", b"", b"", b""))
                kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], _names(_CHUNK)
                )
                number += 1

    return run


def _answers(rows: list[dict]) -> pd.DataFrame:
    blank = dict.fromkeys(("totals", "numbers", "states", "kinds", "kept"), pack(np.zeros(0))) | dict.fromkeys(
        ("depth", "bucket", "vocabulary", "tokens", "state", "singles", "repeated", "n_kinds"), 0
    ) | {"chunk": -1, "weight": 0.0}
    return pd.DataFrame([blank | row for row in rows], columns=_names(_ANSWER))


def _word_totals(buckets: int):
    """In one bucket of words: each chunk's words with their corpus counts and numbers; words never learnt have number -1."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        at = np.concatenate(([0], np.cumsum([len(x) // 8 for x in group["words"]])))
        known, place = np.unique(np.frombuffer(b"".join(group["words"]), np.uint64), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, place, unpack(group["counts"]))
        number = np.where(total > 0, (np.cumsum(total > 0) - 1) * buckets + bucket, -1)
        rows = [{"vocabulary": int((total > 0).sum()), "tokens": int(total.sum())}]
        for k, chunk in enumerate(group["chunk"]):
            mine = place[at[k] : at[k + 1]]
            rows.append({"chunk": int(chunk), "bucket": bucket, "totals": pack(total[mine]), "numbers": pack(number[mine][total[mine] > 0])})
        return _answers(rows)

    return run


def unique_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different pair of numbers occurs first, in order of pairs, and the pair's place for every position."""
    if len(first) and first.max() < 1 << 31 and second.max() < 1 << 32:
        _, at, place = np.unique(first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64), return_index=True, return_inverse=True)
        return at, place
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def gain(singles, repeated, kinds, weight):
    """Log likelihood that a state gains over its suffix, each occurrence predicted from the others.

    A symbol seen once is predicted by the suffix's share alone, one seen n times by n - 1
    occurrences; ``weight`` adds up, for the latter, log of n - 1 less the suffix's log probability.
    """
    rest = np.log(np.maximum(singles + repeated + kinds, 1))
    return weight - repeated * rest + singles * (np.log(np.maximum(kinds, 1)) - rest)


def _pair_totals(depth: int, buckets: int, settings: Settings):
    """In one bucket of pairs: corpus counts for each chunk's pairs, numbers of pairs that may be states, and judged states."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        pieces = [unpack([x]) for x in group["follow"]]
        at = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        sizes = unpack(group["sizes"])
        state, follow = np.repeat(unpack(group["states"]), sizes), np.concatenate(pieces)
        first, place = unique_pairs(state, follow)
        n = np.zeros(len(first), np.int64)
        np.add.at(n, place, unpack(group["learnt"]))
        prior = unpack(group["prior"]).astype(np.uint16).view(np.float16)[first].astype(np.float64)
        cut = np.repeat(unpack(group["cut"]), sizes)[first].astype(bool)
        often = n >= settings.min_count
        number = np.where(often, (np.cumsum(often) - 1) * buckets + bucket, -1)
        start = np.flatnonzero(np.diff(state[first], prepend=-1))
        states, cut = state[first][start], cut[start]
        singles, repeated = np.add.reduceat(n == 1, start), np.add.reduceat(np.where(n > 1, n, 0), start)
        kinds = np.add.reduceat(n > 0, start)
        weight = np.add.reduceat(np.where(n > 1, n * (np.log(np.maximum(n - 1, 1)) - prior), 0.0), start)
        kept = gain(singles, repeated, kinds, weight) >= settings.min_divergence
        rows = []
        for k, chunk in enumerate(group["chunk"]):
            mine = place[at[k] : at[k + 1]]
            own = np.searchsorted(states, np.unique(state[at[k] : at[k + 1]]))
            whole = own[~cut[own]]
            rows.append({
                "chunk": int(chunk), "depth": depth, "bucket": bucket, "totals": pack(n[mine]), "numbers": pack(number[mine][often[mine]]),
                "states": pack(states[whole]), "kinds": pack(kinds[whole]), "kept": pack(kept[whole]),
            })
            rows += [{"chunk": int(chunk), "depth": -1, "state": int(s)} for s in states[own[cut[own]]]]
        for s, x, y, z, w in zip(*(v[cut] for v in (states, singles, repeated, kinds, weight)), strict=True):
            rows.append({"depth": -1, "state": int(s), "singles": int(x), "repeated": int(y), "n_kinds": int(z), "weight": float(w)})
        return _answers(rows)

    return run


def _spread(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Values at the places that have one, -1 at the others."""
    out = np.full(len(there), -1)
    out[there] = values
    return out


class _Walk:
    """The texts of a chunk, walked down the tree as far as it has been answered."""

    def __init__(self, chunk: pd.Series, answers: pd.DataFrame, tokens: int, vocabulary: int, settings: Settings):
        self.settings = settings
        self.ids = np.frombuffer(chunk["ids"], np.int64)
        self.named, self.learns = np.frombuffer(chunk["flags"], np.uint8).reshape(2, -1)
        self.sizes, self.seq = unpack([chunk["sizes"]]), unpack([chunk["seq"]])
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.first = np.zeros(len(self.seq), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True
        answers = answers.sort_values(["depth", "bucket"])
        words_ = answers[answers["depth"] == 0]
        total = unpack(words_["totals"])
        self.word = _spread(unpack(words_["numbers"]), total > 0)[self.seq]
        self.count = total[self.seq]
        self.base = np.log((self.count + 1) / (tokens + vocabulary + 1))
        self.log = self.base
        # The state of a token is the number of the words before it, with how often they occur.
        self.state, self.seen = self._before(np.where(self.count >= settings.min_count, self.word, -1), self.count)

    def _before(self, number: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        state = np.concatenate(([-1], number[:-1]))
        state[self.first] = -1
        return state, np.concatenate(([0], seen[:-1]))

    def pairs(self, buckets: int) -> dict[str, np.ndarray]:
        """Different pairs of state and word, in bucket order; ``place`` gives each token's pair, or -1."""
        here = np.flatnonzero((self.state >= 0) & (self.word >= 0))
        state, follow = self.state[here], self.word[here]
        first, place = unique_pairs(state, follow)
        learnt = np.bincount(place, self.learns[self.owner[here]], minlength=len(first)).astype(np.int64)
        state, follow, seen = state[first], follow[first], self.seen[here][first]
        shares = (1 + seen // self.settings.share).astype(np.uint64)
        share = mix(follow.astype(np.uint64)) % shares
        bucket = (mix(mix(state.astype(np.uint64)) + share) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        token = np.full(len(self.seq), -1)
        token[here] = rank[place]
        return {
            "bucket": bucket[order], "states": state[order], "follow": follow[order], "learnt": learnt[order],
            "prior": self.log[here][first][order].astype(np.float16), "cut": (shares > 1)[order], "place": token,
        }

    def descend(self, pairs: dict[str, np.ndarray], answers: pd.DataFrame, judged: pd.DataFrame, depth: int) -> None:
        """Take the answers to ``pairs``: score each token in its state if that is kept, and go to the next states."""
        mine = answers[answers["depth"] == depth].sort_values("bucket")
        n = np.append(unpack(mine["totals"]), 0)
        number = _spread(unpack(mine["numbers"]), n >= self.settings.min_count)
        states, kinds, kept = unpack(mine["states"]), unpack(mine["kinds"]), unpack(mine["kept"]).astype(bool)
        extra = judged[judged["depth"] == depth] if len(judged) else judged
        if len(extra):
            states, kinds = np.append(states, extra["state"]), np.append(kinds, extra["n_kinds"])
            kept = np.append(kept, extra["gain"] >= self.settings.min_divergence)
        here, count = self.state >= 0, n[pairs["place"]]
        if len(states):
            # A state whose words all are unknown here was not asked for, and tells nothing.
            order = np.argsort(states)
            at = np.minimum(np.searchsorted(states[order], self.state), len(states) - 1)
            here &= (states[order][at] == self.state) & kept[order][at]
            types = kinds[order][at]
            smooth = np.log((count + types * np.exp(self.log)) / np.maximum(self.seen + types, 1))
            self.log = np.where(here, smooth, self.log)
        self.state, self.seen = self._before(np.where(pairs["place"] >= 0, number[pairs["place"]], -1), count)

    def scores(self) -> pd.DataFrame:
        texts = len(self.ids)
        ten = np.log(10.0)
        return pd.DataFrame({
            "doc_id": pd.array([i if k else None for i, k in zip(self.ids.tolist(), self.named, strict=True)], dtype="Int64"),
            "held_out": self.learns == 0, "n_tokens": self.sizes,
            "n_known": np.bincount(self.owner, self.count > 0, minlength=texts).astype(np.int64),
            "base_score": np.bincount(self.owner, self.base, minlength=texts) / ten,
            "score": np.bincount(self.owner, self.log, minlength=texts) / ten,
        })


def _walked(depth: int, buckets: int, tokens: int, vocabulary: int, settings: Settings):
    """For each chunk: its pairs at the level ``depth``, or beyond the last level its scores."""

    def run(_, group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers, judged = answers[answers["state"] < 0], answers[answers["state"] >= 0]
        walk = _Walk(group.iloc[0], answers, tokens, vocabulary, settings)
        for level in range(1, depth):
            walk.descend(walk.pairs(buckets), answers, judged, level)
        if depth > settings.depth:
            return walk.scores()
        pairs = walk.pairs(buckets)
        cut = np.flatnonzero(np.diff(pairs["bucket"], prepend=-1))
        rows = []
        for x, y in zip(cut, np.append(cut[1:], len(pairs["bucket"])), strict=False):
            states = pairs["states"][x:y]
            start = np.flatnonzero(np.diff(states, prepend=-1))
            rows.append((
                int(pairs["bucket"][x]), int(group["chunk"].iloc[0]), pack(states[start]), pack(np.diff(start, append=y - x)),
                pack(pairs["cut"][x:y][start]), pack(pairs["follow"][x:y]), pack(pairs["learnt"][x:y]), pack(pairs["prior"][x:y].view(np.uint16)),
            ))
        return pd.DataFrame(rows, columns=_names(_PAIRS))

    return run


def _answer_rows(answer: DataFrame, depth: int) -> DataFrame:
    """Answers by chunk, and the verdicts on states that were cut over buckets, for the chunks that asked for them."""
    plain = answer.filter("depth >= 0").select(
        F.col("chunk").alias("of"), "depth", "bucket", "totals", "numbers", "states", "kinds", "kept",
        F.lit(-1).cast("long").alias("state"), F.lit(0).cast("long").alias("n_kinds"), F.lit(0.0).alias("gain"),
    )
    sums = answer.filter("depth = -1 and chunk = -1").groupBy("state").agg(
        *[F.sum(c).alias(c) for c in ("singles", "repeated", "n_kinds", "weight")]
    )
    rest = F.log(F.greatest(F.col("singles") + F.col("repeated") + F.col("n_kinds"), F.lit(1)))
    value = F.col("weight") - F.col("repeated") * rest + F.col("singles") * (F.log(F.greatest("n_kinds", F.lit(1))) - rest)
    asked = answer.filter("depth = -1 and chunk <> -1").select("chunk", "state").distinct()
    empty = F.lit(pack(np.zeros(0)))
    judged = asked.join(sums.select("state", "n_kinds", value.alias("gain")), "state").select(
        F.col("chunk").alias("of"), F.lit(depth).alias("depth"), F.lit(0).cast("long").alias("bucket"),
        *[empty.alias(c) for c in ("totals", "numbers", "states", "kinds", "kept")], "state", "n_kinds", "gain",
    )
    return plain.unionByName(judged)


def score_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Rows whose ``crc32`` of the id leaves 2 modulo 7 are held out from learning. Null
    and empty texts are one end token; a null id counts as the empty text. Repeated rows
    count each. Without learning rows every probability is uniform. An empty table gives
    no rows. Other columns are ignored.

    Words are told apart by 64-bit hashes of their bytes.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2).alias("learns"),
    )
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(3, (size // BUCKET_BYTES).bit_length())
    table = cut_lineage(source.mapInArrow(_chunked(buckets, settings), _CHUNK), "lm-chunks")
    texts = table.filter("bucket < 0")
    words_ = table.filter("bucket >= 0").select("bucket", "chunk", "words", "counts")
    answer = cut_lineage(words_.groupBy("bucket").applyInPandas(_word_totals(buckets), _ANSWER), "lm-words")
    total = answer.filter("chunk = -1").agg(F.sum("vocabulary"), F.sum("tokens")).first()
    vocabulary, tokens = total[0] or 0, total[1] or 0
    answers = _answer_rows(answer.filter("chunk <> -1"), 0)
    for depth in range(1, settings.depth + 1):
        walk = _walked(depth, buckets, tokens, vocabulary, settings)
        pairs = texts.groupBy("chunk").cogroup(answers.groupBy("of")).applyInPandas(walk, _PAIRS)
        answer = cut_lineage(pairs.groupBy("bucket").applyInPandas(_pair_totals(depth, buckets, settings), _ANSWER), "lm-pairs")
        answers = answers.unionByName(_answer_rows(answer, depth))
    walk = _walked(settings.depth + 1, buckets, tokens, vocabulary, settings)
    scored = texts.groupBy("chunk").cogroup(answers.groupBy("of")).applyInPandas(walk, _SCORE)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
