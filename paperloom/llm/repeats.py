"""Removing repeated byte strings: position ranks at growing lengths, from sampled positions.

Spark ranks positions by the strings that start there and keeps only positions whose
rank is shared, at growing lengths: 100 bytes, then 369, then 400, the threshold. A
position that becomes unique is out. Ranking every position of a corpus would shuffle
many times its size, so the first length is ranked at sampled positions only: of every
400-byte window the one with the least hash of its 100 bytes. Equal windows sample the
same place, so none is lost, and about one position in 150 is ranked.

A surviving sample owns a run of windows. Runs are cut into blocks of 32 windows. The
369 bytes that all windows of a block share must repeat for any of them to repeat
(second length); if all bytes that they cover repeat, they all do. What is left, the
blocks at an end of a repeat, is ranked window by window (third length). Ranks are
128-bit digests of the strings themselves.

Equal texts are counted once; all their bytes repeat if they are long enough.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrays import chunks, prefix_hash, span_hash, text_bytes
from paperloom.llm.exact_dedup import names_every_row
from paperloom.session import cut_lineage

LENGTH = 400
SAMPLE = 100
BLOCK = 32
_REACH = LENGTH - SAMPLE + 1  # places a sample can have inside a window
_LOW = np.uint64((1 << 21) - 1)
_PIECE = 1 << 20


def _owners(data: np.ndarray) -> np.ndarray:
    """For each window start, where its sampled position is (the last of equal ones)."""
    n = len(data) - SAMPLE + 1
    sums = prefix_hash(data)
    at = np.arange(n)
    keys = (span_hash(sums, at, at + SAMPLE) & ~_LOW) | (_LOW - at.astype(np.uint64))
    # Least key of every run of _REACH keys, by least keys from both ends of aligned blocks.
    size = -(-n // _REACH) * _REACH
    padded = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = keys
    grid = padded.reshape(-1, _REACH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - _REACH + 1
    return (_LOW - (np.minimum(back[:windows], ahead[_REACH - 1 : _REACH - 1 + windows]) & _LOW)).astype(np.int64)


def _runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions of one or more texts laid end to end, with first and last window that each owns."""
    owner = _owners(data)
    cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return owner[cut], cut, np.concatenate((cut[1:], [len(owner)])) - 1


def _pieces(data: np.ndarray, starts: np.ndarray):
    """Stretches of at most ``_PIECE`` bytes: text number of each window, and where the stretch begins.

    Long texts are cut into stretches that overlap by less than a window, so each window lies in one.
    """
    for a, b in chunks(starts, _PIECE):
        low, high = int(starts[a]), int(starts[b])
        if b - a > 1 or high - low <= _PIECE:
            yield a, b, low, high
        else:
            for x in range(low, high, _PIECE - LENGTH + 1):
                yield a, b, x, min(x + _PIECE, high)
                if x + _PIECE >= high:
                    break


def _samples(data: np.ndarray, starts: np.ndarray):
    """``(text, position, first window, last window)`` of all samples, positions counted from the text's start."""
    for a, b, low, high in _pieces(data, starts):
        if high - low < LENGTH:
            continue
        at, first, last = _runs(data[low:high])
        text = np.searchsorted(starts[a : b + 1], first + low, side="right") - 1 + a
        # A run may reach over a text's end; windows that cross it do not exist, and the next text's are its own.
        for _ in range(2):
            end = starts[text + 1] - low - LENGTH
            inside = first <= end
            yield text[inside], (at + low - starts[text])[inside], (first + low - starts[text])[inside], (np.minimum(last, end) + low - starts[text])[inside]
            over = last >= starts[text + 1] - low
            at, first, last, text = at[over], (starts[text + 1] - low)[over], last[over], text[over] + 1
            while len(text) and (skip := (starts[np.minimum(text + 1, b)] - low <= first) & (text + 1 < b)).any():
                text = text + skip
            if not len(text):
                break


def _digest(data: memoryview) -> int:
    return xxhash.xxh3_64_intdigest(data)


def _sampled(batches):
    """Rank of each sample at the first length, with its text's digest: copies of a text give equal rows."""
    for batch in batches:
        names = batch.column("text_key").to_numpy()
        data, starts = text_bytes(batch.column("text"))
        view, out = memoryview(np.ascontiguousarray(data)), ([], [], [])
        for text, at, first, _ in _samples(data, starts):
            place = at + starts[text]
            # A sample in two stretches or runs of one text is one position.
            keep = np.unique(np.stack((text, at)), axis=1, return_index=True)[1]
            text, at, place = text[keep], at[keep], place[keep]
            out[0].append(np.fromiter((_digest(view[p : p + SAMPLE]) for p in place.tolist()), np.uint64, len(place)).view(np.int64))
            out[1].append(names[text])
            out[2].append(at)
        cat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cat], ["rank", "text_key", "at"])


def _wide(data: memoryview) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _blocks(batches):
    """Blocks of windows owned by surviving samples: rank of their common bytes, and of all they cover."""
    for batch in batches:
        docs, survivors = batch.column("doc_id").to_pylist(), batch.column("at")
        data, starts = text_bytes(batch.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        alive = [np.array(x.as_py() or [], dtype=np.int64) for x in survivors]
        rows = ([], [], [], [], [])
        for text, at, first, last in _samples(data, starts):
            for t in np.unique(text).tolist():
                own = text == t
                own &= np.isin(at, alive[t]) if own.any() else own
                base = int(starts[t])
                for a, x, y in zip(at[own].tolist(), first[own].tolist(), last[own].tolist(), strict=True):
                    for block in range((a - y) // BLOCK, (a - x) // BLOCK + 1):
                        high, low = a - BLOCK * block, a - BLOCK * block - BLOCK + 1
                        p, q = max(x, low), min(y, high)
                        if p <= q:
                            rows[0].append(_wide(view[base + high : base + low + LENGTH]))
                            rows[1].append(_wide(view[base + p : base + q + LENGTH]) + (q - p).to_bytes(1, "little"))
                            rows[2].append(docs[t])
                            rows[3].append(p)
                            rows[4].append(q - p + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.binary()), *(pa.array(x, pa.int64()) for x in rows[2:])],
            ["core", "extent", "doc_id", "at", "windows"],
        )


def _windows(batches):
    """Every window of the open blocks, ranked at the full length."""
    for batch in batches:
        data, starts = text_bytes(batch.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        rows = ([], [], [], [], [])
        for k, (doc, blocks) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("blocks").to_pylist(), strict=True)):
            base = int(starts[k])
            for block in blocks:
                for p in range(block["at"], block["at"] + block["windows"]):
                    rows[0].append(_wide(view[base + p : base + p + LENGTH]))
                    rows[1].append(doc)
                    rows[2].append(p)
                    rows[3].append(min(block["times"], 2))
                    rows[4].append(block["times"] < 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.bool_())],
            ["window", "doc_id", "at", "times", "open"],
        )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by ``(begin, end)`` spans; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _cut(batches):
    for batch in batches:
        rows = []
        for text, whole, spans in zip(batch.column("text"), batch.column("whole").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = memoryview(text.as_buffer() or b"")
            runs = [(0, len(raw))] if whole else merged([(s["begin"], s["end"]) for s in spans or []])
            digest, kept, at = hashlib.sha256(), [], 0
            for begin, end in [*runs, (len(raw), len(raw))]:
                digest.update(raw[at:begin])
                if begin > at:
                    kept.append({"begin": at, "end": begin})
                at = end
            rows.append((len(raw), sum(e - b for b, e in runs), len(runs), digest.hexdigest(), kept))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(columns[k], pa.int64()) for k in range(3)), pa.array(columns[3], pa.string()),
             pa.array(columns[4], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """What is left of each text of ``docs`` without its repeated 400-byte strings.

    Columns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``; ``kept`` has the
    byte ranges that stay. A byte goes if any 400-byte string over it also starts
    elsewhere, in the same text or another; all strings are judged on the input. Null
    texts count as empty; texts under 400 bytes stay. Repeated rows are copies of each
    other. Rows without ``doc_id`` are treated alike, their result has a null id. An
    empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    if names_every_row(docs):
        rows = rows.withColumn("row", F.col("doc_id").cast("long"))
    else:  # rows get a number of their own, so that missing or repeated ids do no harm
        rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    keyed = rows.select("row", "text", F.xxhash64("text").alias("text_key"), F.sha2("text", 256).alias("sha"), F.length("text").alias("bytes"))
    long = keyed.filter(f"bytes >= {LENGTH}")
    copies = cut_lineage(
        long.groupBy("sha").agg(F.min("row").alias("row"), F.first("text_key").alias("text_key"), F.count(F.lit(1)).alias("copies")), "copies"
    )
    samples = cut_lineage(
        long.select("text_key", "text").mapInArrow(_sampled, "rank long, text_key long, at long").distinct(), "samples"
    )
    shared = samples.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("rank")
    alive = samples.join(shared, "rank").select("text_key", "at").distinct()
    alive = alive.groupBy("text_key").agg(F.collect_list("at").alias("at"))
    alive = copies.join(alive, "text_key").select("row", "at")
    texts = rows.select(F.col("row").alias("doc_id"), "text")
    blocks = cut_lineage(
        texts.join(alive.withColumnRenamed("row", "doc_id"), "doc_id")
        .mapInArrow(_blocks, "core binary, extent binary, doc_id long, at long, windows long"),
        "blocks",
    )
    extents = cut_lineage(
        blocks.groupBy("core", "extent").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "at", "windows")).alias("one")), "extents"
    )
    settled = blocks.join(extents.filter("times > 1").select("core", "extent"), ["core", "extent"]).select(
        "doc_id", F.col("at").alias("begin"), (F.col("at") + F.col("windows") - 1 + LENGTH).alias("end")
    )
    torn = extents.groupBy("core").agg(F.sum("times").alias("all"), F.min("times").alias("least")).filter("all > 1 and least = 1").select("core")
    open_blocks = (
        extents.join(torn, "core").select("one.doc_id", F.struct("one.at", "one.windows", "times").alias("block"))
        .groupBy("doc_id").agg(F.collect_list("block").alias("blocks"))
    )
    windows = cut_lineage(
        texts.join(open_blocks, "doc_id").mapInArrow(_windows, "window binary, doc_id long, at long, times long, open boolean"), "windows"
    )
    again = windows.groupBy("window").agg(F.sum("times").alias("n")).filter("n > 1").select("window")
    found = windows.filter("open").join(again, "window").select("doc_id", F.col("at").alias("begin"), (F.col("at") + LENGTH).alias("end"))
    spans = settled.unionByName(found).groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    several = keyed.select("row", "sha").join(copies.filter("copies > 1").select("sha"), "sha").select(F.col("row").alias("doc_id"), F.lit(True).alias("whole"))
    marks = spans.join(several, "doc_id", "full")
    return (
        rows.join(marks.withColumnRenamed("doc_id", "row"), "row", "left")
        .select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")
        .mapInArrow(
            _cut,
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept array<struct<begin:long,end:long>>",
        )
    )
