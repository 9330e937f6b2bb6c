"""Near duplicates by Jaccard similarity of five-word shingles, with token-combination prefixes.

Two sets can only reach the similarity if their prefixes, in one global order of
shingles, share one. The order is: shingles of one document first, then rare ones, then
frequent ones.

* A document whose prefix is filled by shingles nobody else has can have no partner.
* If rare shingles fill the prefix, each of those is a key by itself.
* Otherwise two linked documents may share frequent shingles only. Their prefix is then
  extended until neighbouring pairs of frequent shingles must coincide: with an overlap
  ``o`` and ``f`` frequent shingles on each side, ``o - 1`` neighbours are broken by at
  most ``f1 + f2 - 2 o`` others. Pairs are the keys, as many as there are shingles.

Candidates are not all pairs of a key. First every document meets its key's most typical
document; what is linked then needs no more comparison. Only documents of one key that
are still in different components are compared with each other. Every candidate is
verified by the exact overlap, counted on the shingles it shares with anybody.

Shingles are counted in packed arrays: tasks sort 52-bit hashes of many documents and
shuffle them in bucket pieces. A shingle that a chunk of documents holds many times is
sent once for the chunk.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrays import chunks, mix, shingles, text_bytes, word_hashes
from paperloom.llm.components import components
from paperloom.llm.exact_dedup import names_every_row, numbered_rows
from paperloom.session import cut_lineage, drop_scratch, shared_dir

#: A shingle in more documents than this is frequent.
FREQUENT = 50
#: A shingle in so many documents of one chunk is sent once for all of them.
REPEATED = 8
#: Rounds in which documents meet the most typical one of a key, before components meet each other.
HUB_ROUNDS = 2
#: Bytes of packed shingles that one bucket gets, about.
BUCKET_BYTES = 4 << 20
_HASH_BITS = 52
_ALL = np.uint64((1 << 12) - 1)  # stands for "several documents of the chunk"
_MASK = np.uint64((1 << _HASH_BITS) - 1)

_CHUNK = "bucket long, chunk long, tokens binary, ids binary, sizes binary, sums binary, repeated binary"
_DOCS = "doc_id long, n_shingles long, n_shared long, n_frequent long, set_key binary, keys array<long>, tokens binary"


def _chunked(buckets: int):
    """Per chunk of documents: one row about them (a bucket below 0), and one row for each bucket."""
    shift = np.uint64(_HASH_BITS - max(buckets.bit_length() - 1, 0))

    def run(batches):
        context, number = TaskContext.get(), 0
        for batch in batches:
            all_ids = batch.column("doc_id").to_pylist()
            data, starts = text_bytes(batch.column("text"))
            out = {name: [] for name in ("bucket", "chunk", "tokens", "ids", "sizes", "sums", "repeated")}
            for a, b in chunks(starts):
                word, owner = word_hashes(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                values, text = shingles(word, owner, b - a)
                packed = np.unique((text.astype(np.uint64) << np.uint64(_HASH_BITS)) | values)
                text, values = (packed >> np.uint64(_HASH_BITS)).astype(np.int64), packed & _MASK
                sizes = np.bincount(text, minlength=b - a)
                sums = np.zeros((b - a, 2), dtype=np.uint64)
                np.add.at(sums[:, 0], text, mix(values))
                np.add.at(sums[:, 1], text, mix(values ^ np.uint64(0x5DEECE66D1234567)))
                order = np.argsort(values, kind="stable")
                values, text = values[order], text[order]
                first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
                count = np.diff(np.concatenate((first, [len(values)])))
                many = np.repeat(count >= REPEATED, count)
                entries = (text.astype(np.uint64) << np.uint64(_HASH_BITS)) | values
                # Entries of shingles that the chunk repeats stay with the chunk; one for all goes to the bucket.
                hot = first[count >= REPEATED]
                sent = np.concatenate((entries[~many], (_ALL << np.uint64(_HASH_BITS)) | values[hot]))
                weight = np.concatenate((np.ones(int((~many).sum()), np.uint32), count[count >= REPEATED].astype(np.uint32)))
                bucket = ((sent & _MASK) >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(sent), np.int64)
                order = np.argsort(bucket, kind="stable")
                sent, weight, bucket = sent[order], weight[order], bucket[order]
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
                chunk = (context.partitionId() << 32) + number
                number += 1
                ids = all_ids[a:b]
                known = np.array([x is not None for x in ids], dtype=np.uint8)
                out["bucket"].append(-1 - chunk)
                out["chunk"].append(chunk)
                out["tokens"].append(known.tobytes())
                out["ids"].append(np.array([x or 0 for x in ids], dtype=np.int64).tobytes())
                out["sizes"].append(sizes.astype(np.int64).tobytes())
                out["sums"].append(sums.tobytes())
                out["repeated"].append(entries[many].tobytes())
                for x, y in zip(cut, [*cut[1:], len(sent)], strict=True):
                    out["bucket"].append(int(bucket[x]))
                    out["chunk"].append(chunk)
                    out["tokens"].append(sent[x:y].tobytes())
                    heavy = weight[x:y]
                    out["ids"].append(b"" if heavy.max() == 1 else heavy.tobytes())
                    for name in ("sizes", "sums", "repeated"):
                        out[name].append(b"")
            kinds = {"bucket": pa.int64(), "chunk": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()], list(out))

    return run


_PARTS = "chunk long, tokens binary, held binary, ids binary, sizes binary, sums binary, repeated binary, known binary"


def _counted(group: pd.DataFrame) -> pd.DataFrame:
    """In one bucket, keep entries of shingles that several documents hold; note how many do. Rows about chunks pass."""
    names = [part.split()[0] for part in _PARTS.split(", ")]
    if group["bucket"].iloc[0] < 0:
        return group.rename(columns={"tokens": "known"}).assign(tokens=b"", held=b"")[names]
    lengths = np.array([len(x) // 8 for x in group["tokens"]])
    entries = np.frombuffer(b"".join(group["tokens"]), dtype=np.uint64)
    weight = np.ones(len(entries), dtype=np.int64)
    at = np.concatenate(([0], np.cumsum(lengths)))
    for k, heavy in enumerate(group["ids"]):
        if len(heavy):
            weight[at[k] : at[k + 1]] = np.frombuffer(heavy, dtype=np.uint32)
    values = entries & _MASK
    order = np.argsort(values)
    new = np.concatenate(([True], values[order][1:] != values[order][:-1]))
    number = np.empty(len(entries), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    held = np.bincount(number, weight).astype(np.int64)[number]
    rows = []
    for k, chunk in enumerate(group["chunk"]):
        keep = held[at[k] : at[k + 1]] > 1
        if keep.any():
            rows.append((int(chunk), entries[at[k] : at[k + 1]][keep].tobytes(), np.minimum(held[at[k] : at[k + 1]][keep], 2**31).astype(np.uint32).tobytes()))
    found = pd.DataFrame(rows, columns=["chunk", "tokens", "held"])
    return found.assign(ids=b"", sizes=b"", sums=b"", repeated=b"", known=b"")[names]


def required(n: np.ndarray | int, percent: int):
    """Least overlap a set of ``n`` needs with any partner."""
    return -((-percent * n) // 100)


def _keys(tokens: np.ndarray, held: np.ndarray, n: int, percent: int) -> np.ndarray | None:
    """Keys of one document from the shingles it shares, odd for pairs; None if it can have no partner."""
    unique = n - len(tokens)
    prefix = n - required(n, percent) + 1
    if unique >= prefix:
        return None
    rare = np.sort(tokens[held <= FREQUENT])
    if unique + len(rare) >= prefix:
        return _even(rare[: prefix - unique])
    frequent = np.sort(tokens[held > FREQUENT])
    slack = n * (100 - percent) // 100 + n * (100 - percent) // percent + 2
    extended = frequent[: max(len(frequent) - required(n, percent), 0) + slack + 1]
    pairs = mix(extended[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(extended[1:])) if len(extended) > 1 else mix(extended)
    return np.concatenate((_even(rare), pairs | np.uint64(1)))


def _even(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens) & ~np.uint64(1)


def _gathered(percent: int):
    """All documents of a chunk again, with keys for those that may have partners."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        about = group[group["sizes"].str.len() > 0]
        rest = group[group["sizes"].str.len() == 0]
        if not len(about):
            return pd.DataFrame(columns=["doc_id", "n_shingles", "n_shared", "n_frequent", "set_key", "keys", "tokens"])
        about = about.iloc[0]
        ids = np.frombuffer(about["ids"], np.int64)
        known = np.frombuffer(about["known"], np.uint8)
        sizes = np.frombuffer(about["sizes"], np.int64)
        sums = about["sums"]
        entries = np.frombuffer(b"".join(rest["tokens"]), np.uint64)
        held = np.frombuffer(b"".join(rest["held"]), np.uint32)
        several = (entries >> np.uint64(_HASH_BITS)) == _ALL
        repeated = np.frombuffer(about["repeated"], np.uint64)
        if len(repeated):
            hot, hot_held = entries[several] & _MASK, held[several]
            order = np.argsort(hot)
            found = hot_held[order][np.searchsorted(hot[order], repeated & _MASK)]
            entries, held = np.concatenate((entries[~several], repeated)), np.concatenate((held[~several], found))
        order = np.argsort(entries)
        entries, held = entries[order], held[order]
        at = np.searchsorted(entries >> np.uint64(_HASH_BITS), np.arange(len(ids) + 1).astype(np.uint64))
        rows = []
        for k, (doc_id, n) in enumerate(zip(ids.tolist(), sizes.tolist(), strict=True)):
            doc_id = doc_id if known[k] else None
            tokens = entries[at[k] : at[k + 1]] & _MASK
            keys = _keys(tokens, held[at[k] : at[k + 1]], n, percent) if n and len(tokens) and doc_id is not None else None
            if keys is None:
                rows.append((doc_id, n, len(tokens), 0, None, None, None))
            else:
                rows.append((doc_id, n, len(tokens), int((held[at[k] : at[k + 1]] > FREQUENT).sum()), sums[16 * k : 16 * k + 16] + n.to_bytes(8, "little"), keys.view(np.int64), tokens.tobytes()))
        return pd.DataFrame(rows, columns=["doc_id", "n_shingles", "n_shared", "n_frequent", "set_key", "keys", "tokens"]).astype({"doc_id": "Int64"})

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            size_a, size_b = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (size_a[k] + size_b[k] - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])

    return run


def _possible(percent: int):
    """Whether two sets of one key can still reach the similarity.

    Under a single's key they share at most what they share with anybody. A pair's key
    matters to documents without a common rare shingle only, since all their rare ones
    are keys; those share frequent shingles at most.
    """
    most = F.when(F.col("key").bitwiseAND(1) == 1, F.least("f_a", "f_b")).otherwise(F.least("s_a", "s_b"))
    return 100 * most >= percent * (F.col("n_a") + F.col("n_b") - most)


def _sides(rows: DataFrame, one: str, two: str) -> DataFrame:
    """The columns of two documents of one key, ``a`` the smaller id."""
    pick = [F.col("key")]
    low = F.col(f"{one}.rep") < F.col(f"{two}.rep")
    for name, field in (("", "rep"), ("n_", "n"), ("s_", "s"), ("f_", "f")):
        x, y = F.col(f"{one}.{field}"), F.col(f"{two}.{field}")
        pick += [F.when(low, x).otherwise(y).alias(f"{name}a"), F.when(low, y).otherwise(x).alias(f"{name}b")]
    return rows.select(*pick)


def _possible_structs(percent: int):
    """The same test on the structs ``one`` and ``two`` of a join."""
    most = F.when(F.col("key").bitwiseAND(1) == 1, F.least("one.f", "two.f")).otherwise(F.least("one.s", "two.s"))
    return 100 * most >= percent * (F.col("one.n") + F.col("two.n") - most)


def _written(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows written to the shared folder, and where."""
    path = shared_dir(rows.sparkSession, "postings")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _torn(rows: DataFrame, label: DataFrame) -> tuple[DataFrame, str]:
    """Rows of keys that still hold several components, with their present labels, and where they are written."""
    rows = rows.select("key", "one", F.col("one.rep").alias("rep")).join(label, "rep", "left")
    rows = rows.select("key", "one", F.coalesce("label", "rep").alias("label"))
    torn = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    return _written(rows.join(torn, "key"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one = sets.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(_linked(percent), "a long, b long, linked boolean")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``, whole texts compared.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their
    shingle sets; ``component_id`` is the smallest id reachable by links. Null or empty
    texts have no shingle and link with nothing. Rows without ``doc_id`` come back with
    null ids and link with nothing. Repeated rows and equal sets are one component; two
    texts under one id are two documents. An empty table gives no rows. Other columns
    are ignored. ``percent`` is 50 to 100.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if names_every_row(source.filter("doc_id is not null")):
        return _labelled(source, percent)
    rows = numbered_rows(source)
    found = cut_lineage(_labelled(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("__paperloom_row")).alias("doc_id"), "text"), percent), "labels")
    named = found.withColumnRenamed("doc_id", "__paperloom_row").join(rows.select("__paperloom_row", "doc_id"), "__paperloom_row")
    least = named.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return named.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id")).unionByName(
        found.filter("doc_id is null")
    )


def _labelled(docs: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` of rows whose ``doc_id`` is a number of their own or null."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(4, int(size * 8 / 6 / BUCKET_BYTES).bit_length())
    packed = source.mapInArrow(_chunked(buckets), _CHUNK)
    counted = packed.groupBy("bucket").applyInPandas(_counted, _PARTS)
    gathered = cut_lineage(counted.groupBy("chunk").applyInPandas(_gathered(percent), _DOCS), "sets")
    able = gathered.filter("set_key is not null")
    named = able.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    sets = cut_lineage(
        able.select("doc_id", "n_shingles", "n_shared", "n_frequent", "keys", "tokens").join(named, F.col("doc_id") == F.col("rep")), "able"
    )
    one = F.struct("own", "rep", "n", "s", "f").alias("one")
    postings = sets.select(
        F.explode("keys").alias("key"), (F.col("n_shingles") - F.col("n_frequent")).alias("own"), "rep",
        F.col("n_shingles").alias("n"), F.col("n_shared").alias("s"), F.col("n_frequent").alias("f"),
    ).select("key", one)
    several = postings.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1").select("key")
    rows, path = _written(postings.join(several, "key").select("key", "one", F.col("one.rep").alias("label")))
    checked = label = None
    for _ in range(HUB_ROUNDS):
        # The most typical document of each component in a key meets the key's other components.
        hubs = rows.groupBy("key").agg(F.min(F.struct("one", "label")).alias("hub"))
        star = _sides(rows.join(hubs, "key").filter("label <> hub.label").select("key", "one", F.col("hub.one").alias("hub")), "one", "hub")
        pairs = star.filter(_possible(percent)).select("a", "b").distinct()
        pairs = pairs if checked is None else pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        found = _verified(pairs, sets, percent)
        checked = cut_lineage(found if checked is None else checked.unionByName(found), "links")
        label = components(checked.filter("linked")).withColumnRenamed("node", "rep")
        (rows, path), before = _torn(rows, label), path
        drop_scratch(rows.sparkSession, before)  # nothing reads the keys of before any more
    # What one key's documents still have to settle: those in different components.
    left, right = rows.select("key", "one", "label"), rows.select(F.col("key").alias("key_b"), F.col("one").alias("two"), F.col("label").alias("label_b"))
    met = left.join(right, (F.col("key") == F.col("key_b")) & (F.col("one.rep") < F.col("two.rep")) & (F.col("label") != F.col("label_b")) & _possible_structs(percent))
    rest = met.select(F.col("one.rep").alias("a"), F.col("two.rep").alias("b")).distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti")
    late = cut_lineage(_verified(rest, sets, percent), "links")
    late_label = components(checked.unionByName(late).filter("linked")).withColumnRenamed("node", "rep")
    same = able.join(named, "set_key").select(F.col("doc_id").alias("_doc"), "rep").distinct()
    named_docs = same.join(late_label, "rep", "left").select("_doc", F.coalesce("label", "rep").alias("component_id"))
    return gathered.select("doc_id", "n_shingles").join(named_docs, F.col("doc_id") == F.col("_doc"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``: that with the smallest ``doc_id``, one of repeated rows.

    Rows are judged one by one: rows without ``doc_id`` link as others do and lose against them.
    """
    if names_every_row(docs):
        others = _labelled(docs, percent).filter("doc_id <> component_id").select(F.col("doc_id").alias("__paperloom_copy"))
        return docs.join(others, F.col("doc_id") == F.col("__paperloom_copy"), "left_anti")
    rows = numbered_rows(docs)
    found = _labelled(rows.select(F.col("__paperloom_row").alias("doc_id"), "text"), percent).select(F.col("doc_id").alias("__paperloom_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "__paperloom_row")
    kept = found.join(rows.select("__paperloom_row", "doc_id"), "__paperloom_row").groupBy("component_id").agg(F.min(order).alias("first")).select("first.__paperloom_row")
    return rows.join(kept, "__paperloom_row", "left_semi").select(docs.columns)
