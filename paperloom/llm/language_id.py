"""Language identification with error-correcting output codes over byte n-grams.

Each language gets a codeword. One binary classifier per bit weighs hashed n-grams by
the log ratio of their counts in the languages on either side of the bit. The counts
cover all labelled rows: they are one Spark aggregation of ``languages x FEATURES``
numbers at most, so what reaches the driver has a fixed bound per language. A text's
margins are decoded by the loss they have against each codeword, each bit weighted by
how well it separates the learned languages; near ties are flagged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrays import chunks, lower, text_bytes

FEATURES = 1 << 13
#: More labels than this cannot be a language column.
MAX_LANGUAGES = 4096
#: A text is ambiguous if its two best languages' shares are closer than this.
NEAR_TIE = 0.02
UNKNOWN = "und"
_ORDERS = (1, 2, 3)


def _grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and text number of every byte n-gram inside a text."""
    data = lower(data).astype(np.uint32)
    text = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    features, owners = [], []
    code = np.zeros(len(data), dtype=np.uint32)
    for order in _ORDERS:
        n = max(len(data) - order + 1, 0)
        code = code[:n] * np.uint32(257) + data[order - 1 :] + np.uint32(1)
        inside = text[:n] == text[order - 1 :]
        mixed = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
        features.append(mixed[inside])
        owners.append(text[:n][inside])
    return np.concatenate(features), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Codewords ``(languages, bits)`` of +1 and -1, and the weights of each bit's classifier."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    bit_weights: np.ndarray


def codewords(languages: int) -> np.ndarray:
    """Distinct codewords that differ in many bits: one-against-rest bits and pseudo-random halves."""
    own = 2 * np.eye(languages) - 1
    rng = np.random.default_rng(20_240_601)
    halves = []
    for _ in range(max(4, 2 * int(np.ceil(np.log2(max(languages, 2)))))):
        bit = np.ones(languages)
        bit[rng.permutation(languages)[: languages // 2]] = -1
        halves.append(bit)
    return np.column_stack([own, *halves]) if languages > 1 else np.ones((1, 1))


def fit(labelled: DataFrame) -> LanguageModel:
    """Learn from all rows of ``labelled`` (``text``, ``lang``); rows with a null in either are left out."""
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")

    def counted(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
            for a, b in chunks(starts):
                features, owner = _grams(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                names, code = np.unique(langs[a:b].astype(str), return_inverse=True)
                counts = np.bincount(code[owner] * FEATURES + features, minlength=len(names) * FEATURES)
                for name, row in zip(names, counts.reshape(len(names), FEATURES), strict=True):
                    totals[str(name)] = totals.get(str(name), 0) + row
        for name, row in totals.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used.astype(np.int32)), pa.array(row[used].astype(np.int64))],
                ["lang", "feature", "n"],
            )

    counts = rows.mapInArrow(counted, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("feature", "n"))).alias("counts"))
    table = found.limit(MAX_LANGUAGES + 1).orderBy("lang").collect()
    if len(table) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in table]
    if not languages:
        return LanguageModel([], np.ones((0, 1)), np.zeros((FEATURES, 1)), np.zeros(1), np.ones(1))
    share = np.zeros((len(languages), FEATURES))
    for k, row in enumerate(table):
        share[k, list(row["counts"].keys())] = list(row["counts"].values())
    share = (share + 0.5) / (share.sum(axis=1, keepdims=True) + 0.5 * FEATURES)
    codes = codewords(len(languages))
    weights = np.zeros((FEATURES, codes.shape[1]))
    for b in range(codes.shape[1]):
        if (codes[:, b] < 0).any() and (codes[:, b] > 0).any():
            weights[:, b] = np.log(share[codes[:, b] > 0].mean(axis=0) / share[codes[:, b] < 0].mean(axis=0))
    expected = share @ weights  # margin of each language's mean text
    high = np.where(codes > 0, expected, np.inf).min(axis=0)
    low = np.where(codes < 0, expected, -np.inf).max(axis=0)
    bounded = np.isfinite(high) & np.isfinite(low)
    bias = np.where(bounded, (np.where(bounded, high, 0) + np.where(bounded, low, 0)) / 2, 0.0)
    gap = np.where(bounded, np.where(bounded, high, 0) - np.where(bounded, low, 0), 0.0)
    scale = np.where(gap > 0, gap / 2, 1.0)
    spread = np.maximum(gap, 1e-3)
    return LanguageModel(languages, codes, weights / scale, bias / scale, spread / spread.sum())


def _decode(model: LanguageModel, margins: np.ndarray) -> np.ndarray:
    """Share of each language from the weighted exponential losses of its codeword."""
    z = np.clip(margins[:, None, :] * model.codes[None, :, :], -8, 8)
    loss = (np.exp(-z) * model.bit_weights).sum(axis=2)
    score = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 3)
    return score / score.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """Columns ``keep`` and ``lang_pred, score, ambiguous``, or other ``names``, for each row of ``docs``.

    ``lang_pred`` is ``und`` (score 0) for a null text, a text without a letter, or a
    model without languages. The whole text counts. Equal losses go to the language
    that sorts first and are flagged ambiguous. An empty table gives no rows.
    """
    weights = model.weights.astype(np.float32)
    source = docs.select(*keep, F.col("text").alias("__paperloom_text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__paperloom_letters"))

    def decoded(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("__paperloom_text"))
            letters = batch.column("__paperloom_letters").to_numpy(zero_copy_only=False).astype(bool)
            found, scores, near = [], [], []
            for a, b in chunks(starts):
                features, owner = _grams(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                n = np.maximum(np.bincount(owner, minlength=b - a), 1)
                margins = np.empty((b - a, weights.shape[1]))
                for bit in range(weights.shape[1]):
                    margins[:, bit] = np.bincount(owner, weights[features, bit], minlength=b - a) / n - model.bias[bit]
                if not model.languages:
                    found += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    near += [False] * (b - a)
                    continue
                share = _decode(model, margins)
                best = share.argmax(axis=1)
                top = share[np.arange(b - a), best]
                second = np.partition(share, -2, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(b - a)
                known = letters[a:b]
                found += [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                scores += np.where(known, top, 0.0).tolist()
                near += (known & (top - second < NEAR_TIE)).tolist()
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(near, pa.bool_())],
                [*keep, *names],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields)
    return source.mapInArrow(decoded, f"{fields}, {names[0]} string, {names[1]} double, {names[2]} boolean")


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous``, learned from the rows not held out."""
    source = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    return predict(source, fit(source.filter("not held_out")), ["doc_id", "held_out"])


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told: no null text, none without letters, no near tie.

    All columns pass, whatever their names; only those that begin with ``__paperloom_`` are reserved.
    """
    own = ("__paperloom_lang", "__paperloom_score", "__paperloom_ambiguous")
    found = predict(docs, fit(docs.filter(~held_out())), docs.columns, own)
    return found.filter(f"{own[0]} <> '{UNKNOWN}' and not {own[2]}").select(*docs.columns)
