"""Approximate nearest neighbours by a forest of sorted hash strings.

Every tree hashes a vector to a string of 64 bits, one for each of its random planes, and
keeps all vectors in the order of their strings. That order is a Spark range sort, cut
into blocks that fit a task. A query descends in each tree to its longest matching prefix
and ascends in all trees at once: its prefix length is the greatest at which the trees
together hold enough candidates, and all vectors that share so long a prefix with it in
any tree are compared by inner product. Long strings cut dense places as finely as needed.

How many candidates are enough is fitted on a bounded sample of queries, which are
compared with every vector: the least number at which the sample finds ``recall`` of its
neighbours. So the number follows the data and not a fixed guess, up to a full search
where prefixes say nothing.

Greatest inner products become least angles by one more component, which lifts each
vector to the greatest length found and is zero for queries. Equal vectors are searched
once: a vector stands for its rows by the smallest ids that a result can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

TREES = 10
BITS = 64
#: Bytes of vectors in a block of a sorted array, and queries compared with a block in one task.
BLOCK_BYTES, PROBES = 4 << 20, 4_096
#: Bytes of numbers that a task holds at once while it hashes or compares.
PIECE_BYTES = 32 << 20
#: Queries that the number of candidates is fitted on, and vectors that planes are centred on.
SAMPLE_QUERIES, SAMPLE_VECTORS = 200, 4_096
#: Share of neighbours that the sample must find.
RECALL = 0.96
_SHIFTS = np.arange(BITS - 1, -1, -1, dtype=np.uint64)


@dataclass(frozen=True)
class Planes:
    """Planes of all trees: normals for ``width + 1`` components, offsets, and the greatest length."""

    normals: np.ndarray
    offsets: np.ndarray
    longest: float

    def strings(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """Hash strings of rows, one column a tree."""
        length = np.sqrt((vectors * vectors).sum(axis=1))
        if queries:
            lifted = np.concatenate((vectors / length[:, None], np.zeros((len(vectors), 1))), axis=1)
        else:
            share = vectors / self.longest
            rest = np.sqrt(np.maximum(0.0, 1.0 - (length / self.longest) ** 2))
            lifted = np.concatenate((share, rest[:, None]), axis=1)
        bits = (lifted @ self.normals > self.offsets).reshape(len(vectors), -1, BITS)
        return (bits.astype(np.uint64) << _SHIFTS).sum(axis=2, dtype=np.uint64)


def _prefix(strings: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """The first ``level`` bits of each string, the others zero."""
    drop = (BITS - np.asarray(level)).astype(np.uint64)
    return np.where(drop >= BITS, np.uint64(0), (strings >> np.minimum(drop, np.uint64(63))) << np.minimum(drop, np.uint64(63)))


def _after(prefix: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """The last string with this prefix."""
    drop = (BITS - np.asarray(level)).astype(np.uint64)
    low = np.where(drop >= BITS, ~np.uint64(0), (np.uint64(1) << np.minimum(drop, np.uint64(63))) - np.uint64(1))
    return prefix | low


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of strings."""
    differing = a ^ b
    high, low = differing >> np.uint64(32), differing & np.uint64(0xFFFFFFFF)
    used = np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp(low.astype(np.float64))[1])
    return BITS - used


def _signed(strings: np.ndarray) -> np.ndarray:
    """Strings as longs in the same order."""
    return (strings ^ np.uint64(1 << 63)).view(np.int64)


def _unsigned(longs: np.ndarray) -> np.ndarray:
    return longs.view(np.uint64) ^ np.uint64(1 << 63)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` doubles; shorter vectors end in zeros."""
    sizes = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their vectors and bits need bounded memory."""
    rows = max(1, PIECE_BYTES // (8 * (width + BITS * TREES)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, added component by component: equal vectors give equal values."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part: ``id, vec``, with an id and a vector that is finite and not zero.

    Zeros at the end of a vector are cut, so that vectors of other lengths compare as if
    the shorter one ended in zeros.
    """
    # Floats stay floats, which doubles hold exactly; other numbers become doubles.
    kind = "float" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "double"
    vec = F.transform(F.col(vector), lambda x: x.cast(kind))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    ended = F.expr("slice(vec, 1, cast(coalesce(array_max(transform(vec, (x, i) -> if(x <> 0, i + 1, 0))), 0) as int))")
    rows = vectors.select(F.col(key).cast("long").alias("id"), vec.alias("vec")).filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
    return rows.withColumn("vec", ended).filter(F.size("vec") > 0).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0).cast(kind)))


def vector_classes(rows: DataFrame, keep: int) -> DataFrame:
    """Different vectors: ``node, vec, first, ids`` with the ``keep`` smallest ids of each.

    Ids beyond ``keep`` cannot be in a result that has fewer places, ties going to smaller ids.
    """
    same = Window.partitionBy("vec").orderBy("id")
    least = rows.distinct().withColumn("place", F.row_number().over(same)).filter(F.col("place") <= keep)
    found = least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return cut_lineage(
        found.select(F.monotonically_increasing_id().alias("node"), "vec", F.col("ids")[0].alias("first"), "ids"), "forest-nodes"
    )


def fit_planes(nodes: DataFrame, width: int, seed: int) -> Planes:
    """Random planes, moved so that each halves a bounded sample of the vectors."""
    longest = nodes.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()[0]
    random = np.random.default_rng(seed)
    normals = random.standard_normal((width + 1, TREES * BITS))
    sample = nodes.orderBy(F.xxhash64("first", F.lit(seed)), "node").limit(SAMPLE_VECTORS).select("vec").collect()
    plain = Planes(normals, np.zeros(TREES * BITS), float(longest))
    matrix = np.zeros((len(sample), width))
    for k, row in enumerate(sample):
        matrix[k, : len(row[0])] = row[0]
    share = matrix / plain.longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (share * share).sum(axis=1)))
    return Planes(normals, np.median(np.concatenate((share, rest[:, None]), axis=1) @ normals, axis=0), plain.longest)


def fit_candidates(nodes: DataFrame, queries: DataFrame, planes: Planes, width: int, k: int, recall: float, seed: int) -> int:
    """The least number of candidates at which a bounded sample of ``queries`` finds ``recall`` of its neighbours.

    Each task compares its vectors with the sample and passes on ``k`` neighbours and the
    candidates at each prefix length, so what comes together is bounded.
    """
    sample = queries.orderBy(F.xxhash64("first", F.lit(seed + 1)), "node").limit(SAMPLE_QUERIES).select("node", "vec").collect()
    if not sample:
        return 1
    matrix = np.zeros((len(sample), width))
    for n, row in enumerate(sample):
        matrix[n, : len(row["vec"])] = row["vec"]
    own = np.array([row["node"] for row in sample])
    strings = planes.strings(matrix, True)
    levels = np.arange(BITS + 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((len(sample), 0))
        shared = np.zeros((len(sample), 0), dtype=np.int64)
        counts = np.zeros((len(sample), BITS + 1), dtype=np.int64)
        for batch in _pieces(batches, width):
            vectors = _matrix(batch.column("vec"), width)
            hashes = planes.strings(vectors, False)
            score = matrix @ vectors.T
            score[own[:, None] == batch.column("node").to_numpy()[None, :]] = -np.inf
            for t in range(TREES):
                order = np.sort(hashes[:, t])
                low = _prefix(strings[:, t][:, None], levels[None, :])
                counts += np.searchsorted(order, _after(low, levels[None, :]), "right") - np.searchsorted(order, low, "left")
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            found = np.take_along_axis(score, top, axis=1)
            bits = np.max([_shared_bits(strings[:, t][:, None], hashes[:, t][top]) for t in range(TREES)], axis=0)
            best, shared = np.concatenate((best, found), axis=1), np.concatenate((shared, bits), axis=1)
            order = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, shared = np.take_along_axis(best, order, axis=1), np.take_along_axis(shared, order, axis=1)
        n, places = best.shape
        real = np.isfinite(best).ravel()
        rows = [
            np.concatenate((np.repeat(np.arange(n), places)[real], np.repeat(np.arange(n), BITS + 1))),
            np.concatenate((shared.ravel()[real], np.tile(levels, n))),
            np.concatenate((best.ravel()[real], np.zeros(n * (BITS + 1)))),
            np.concatenate((np.zeros(int(real.sum()), np.int64), counts.ravel())),
            np.concatenate((np.ones(int(real.sum()), bool), np.zeros(n * (BITS + 1), bool))),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["query", "level", "score", "n", "near"])

    seen = cut_lineage(nodes.select("node", "vec").mapInArrow(compare, "query long, level long, score double, n long, near boolean"), "forest-fit")
    near = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("level"))
    top = seen.filter("near").withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k).select("query", "level").collect()
    totals = seen.filter("not near").groupBy("query", "level").agg(F.sum("n").alias("n")).collect()
    sizes = np.zeros((len(sample), BITS + 1), dtype=np.int64)
    for row in totals:
        sizes[row["query"], row["level"]] = row["n"]
    met = np.zeros((len(sample), BITS + 1), dtype=np.int64)
    for row in top:
        met[row["query"], : row["level"] + 1] += 1
    if not top:
        return 1
    # A query stops at its greatest level with enough candidates.
    tried = np.unique(sizes)
    low, high = 0, len(tried) - 1
    while low < high:
        middle = (low + high) // 2
        level = np.maximum((sizes >= tried[middle]).sum(axis=1) - 1, 0)
        if met[np.arange(len(sample)), level].sum() >= recall * met[:, 0].sum():
            high = middle
        else:
            low = middle + 1
    return max(1, int(tried[low]))


def _hashed(planes: Planes, width: int, queries: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, width):
            strings = _signed(planes.strings(_matrix(batch.column("vec"), width), queries))
            rows = np.repeat(np.arange(batch.num_rows), TREES)
            whole = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), batch.num_rows)), pa.array(np.ascontiguousarray(strings).ravel()),
                 whole.column("node"), whole.column("first"), whole.column("vec")],
                ["tree", "hash", "node", "first", "vec"],
            )

    return run


_BLOCKS = (
    "block long, tree int, hashes binary, nodes binary, firsts binary, vectors binary, query_hashes binary, query_nodes binary"
)


def _packed(width: int, kind: type):
    """Each tree's run of sorted entries in a partition as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {name: [] for name in ("part", "tree", "hash", "node", "first", "asks")}
        vectors = []
        for batch in batches:
            if batch.num_rows:
                for name, parts in columns.items():
                    parts.append(batch.column(name).to_numpy(zero_copy_only=False))
                vectors.append(_matrix(batch.column("vec"), width))
        if not vectors:
            return
        part, tree, hashes, node, first, asks = (np.concatenate(parts) for parts in columns.values())
        matrix = np.concatenate(vectors)
        for t in np.unique(tree):
            point, query = (tree == t) & ~asks, (tree == t) & asks
            row = [
                int(part[0]) * TREES + int(t), int(t), _unsigned(hashes[point]).tobytes(), node[point].tobytes(), first[point].tobytes(),
                matrix[point].astype(kind).tobytes(), _unsigned(hashes[query]).tobytes(), node[query].tobytes(),
            ]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], [c.split()[0] for c in _BLOCKS.split(", ")]
            )

    return run


def _numbers(nodes: DataFrame) -> type:
    return np.float32 if nodes.schema["vec"].dataType.elementType.typeName() == "float" else np.float64


def _entry_form(nodes: DataFrame) -> str:
    return f"tree int, hash long, node long, first long, vec {nodes.schema['vec'].dataType.simpleString()}"


def sorted_arrays(points: DataFrame, queries: DataFrame, planes: Planes, width: int) -> DataFrame:
    """The trees: entries of all vectors and queries in string order, cut into blocks."""
    form, kind = _entry_form(points), _numbers(points)
    columns = ["node", "first", "vec"]
    entries = points.select(*columns).mapInArrow(_hashed(planes, width, False), form).withColumn("asks", F.lit(False))
    asking = queries.select(*columns).mapInArrow(_hashed(planes, width, True), form)
    # A query's entry only marks its place.
    asking = asking.withColumn("asks", F.lit(True)).withColumn("vec", F.array().cast(points.schema["vec"].dataType))
    parts = max(1, -(-points.count() * TREES * width * kind().nbytes // BLOCK_BYTES))
    # Equal strings are told apart by node, so a block never has to hold all of them.
    order = ["tree", "hash", "asks", "node"]
    ordered = entries.unionByName(asking).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("part", F.spark_partition_id().cast("long"))
    return cut_lineage(numbered.mapInArrow(_packed(width, kind), _BLOCKS), "forest-blocks")


_COUNTS = "kind int, query long, tree int, level int, prefix long, block long, n long"
_INSIDE, _CROSSING, _EDGE = 0, 1, 2


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates at each prefix length: of queries inside a block, of those that cross its ends, and of the ends.

    A prefix that neither the first nor the last entry of a block has lies in that block alone.
    """
    levels = np.arange(BITS + 1)
    names = [c.split()[0] for c in _COUNTS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            hashes, asked = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["query_hashes"], np.uint64)
            nodes = np.frombuffer(row["query_nodes"], np.int64)
            every = [x[[0, -1]] for x in (hashes, asked) if len(x)]
            ends = np.array([min(x[0] for x in every), max(x[1] for x in every)], dtype=np.uint64)
            edges = _prefix(ends[:, None], levels[None, :])
            size = np.searchsorted(hashes, _after(edges, levels), "right") - np.searchsorted(hashes, edges, "left")
            once = np.ones((2, BITS + 1), bool)
            once[1] = edges[0] != edges[1]
            level = np.broadcast_to(levels, (2, BITS + 1))[once]
            parts = [(np.full(level.size, _EDGE), np.zeros(level.size, np.int64), level, edges[once], size[once])]
            for a in range(0, len(asked), 4096):  # a bounded piece at a time
                strings = asked[a : a + 4096]
                prefix = _prefix(strings[:, None], levels[None, :])
                count = np.searchsorted(hashes, _after(prefix, levels), "right") - np.searchsorted(hashes, prefix, "left")
                crossing = (prefix == edges[0]) | (prefix == edges[1])
                said = crossing | (count > 0)
                who, at = np.nonzero(said)
                parts.append((np.where(crossing[said], _CROSSING, _INSIDE), nodes[a + who], at, prefix[said], count[said]))
            kind, query, level, prefix, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            size = len(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind.astype(np.int32)), pa.array(query), pa.array(np.full(size, row["tree"], np.int32)), pa.array(level.astype(np.int32)),
                 pa.array(_signed(prefix)), pa.array(np.full(size, row["block"], np.int64)), pa.array(n.astype(np.int64))],
                names,
            )


def _ascended(blocks: DataFrame, enough: int) -> DataFrame:
    """Where each query looks: ``query, block, level``, at its greatest prefix length with enough candidates in all trees."""
    counts = cut_lineage(blocks.mapInArrow(_descend, _COUNTS), "forest-counts")
    node = ["tree", "level", "prefix"]
    edges = counts.filter(F.col("kind") == _EDGE).select(*node, "block", "n")
    asked = counts.filter(F.col("kind") != _EDGE).select("kind", "query", *node, "block", "n")
    crossing = asked.filter(F.col("kind") == _CROSSING).select("query", *node)
    inside = asked.filter(F.col("kind") == _INSIDE)
    across = crossing.join(edges.groupBy(*node).agg(F.sum("n").alias("n")), node).select("query", "level", "n")
    totals = inside.select("query", "level", "n").unionByName(across).groupBy("query", "level").agg(F.sum("n").alias("n"))
    # At no bits at all every tree offers everything, so each query has a level.
    chosen = totals.filter((F.col("n") >= enough) | (F.col("level") == 0)).groupBy("query").agg(F.max("level").alias("level"))
    chosen = cut_lineage(chosen, "forest-levels")
    near = inside.join(chosen, ["query", "level"]).select("query", "block", "level")
    far = crossing.join(chosen, ["query", "level"]).join(edges.filter("n > 0").select(*node, "block"), node).select("query", "block", "level")
    return near.unionByName(far)


def _compared(width: int, keep: int, kind: type):
    """The best ``keep`` vectors of a block for each query that looks there."""

    def run(_, probes: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": pd.Series(dtype="int64"), "node": pd.Series(dtype="int64"), "first": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(probes) or not len(blocks):
            return none
        block = blocks.iloc[0]
        hashes, nodes, firsts = (np.frombuffer(block[c], kind) for c, kind in (("hashes", np.uint64), ("nodes", np.int64), ("firsts", np.int64)))
        points = np.frombuffer(block["vectors"], kind).reshape(-1, width).astype(np.float64)
        asked = np.zeros((len(probes), width))
        for k, vec in enumerate(probes["vec"]):
            asked[k, : len(vec)] = vec
        strings = _unsigned(probes["hash"].to_numpy(np.int64).copy())
        level = probes["level"].to_numpy()
        low = _prefix(strings, level)
        start, stop = np.searchsorted(hashes, low, "left"), np.searchsorted(hashes, _after(low, level), "right")
        who = probes["query"].to_numpy()
        out: list[tuple] = []
        order = np.lexsort((stop, start))
        cuts = np.flatnonzero(np.diff(start[order]) | np.diff(stop[order])) + 1
        for group in np.split(order, cuts):
            a, b = start[group[0]], stop[group[0]]
            if a == b:
                continue
            for at in range(0, len(group), 128):
                some = group[at : at + 128]
                score = asked[some] @ points[a:b].T
                # Rounding of this product must not decide: all within it of the last place are added up again.
                slack = 1e-12 * np.sqrt((asked[some] ** 2).sum(axis=1) * (points[a:b] ** 2).sum(axis=1).max())
                last = np.full(len(some), -np.inf) if b - a <= keep else np.partition(score, b - a - keep, axis=1)[:, b - a - keep]
                row, column = np.nonzero(score >= (last - slack)[:, None])
                exact = _products(asked[some][row], points[a:b][column])
                best = np.lexsort((firsts[a:b][column], -exact, row))
                place = np.arange(len(best)) - np.searchsorted(row[best], row[best], "left")
                best = best[place < keep]
                out.append((who[some][row[best]], nodes[a:b][column[best]], firsts[a:b][column[best]], exact[best]))
        if not out:
            return none
        return pd.DataFrame(dict(zip(("query", "node", "first", "score"), (np.concatenate(x) for x in zip(*out, strict=True)), strict=True)))

    return run


def nearest(
    vectors: DataFrame, asks, key: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = RECALL, seed: int = 1
) -> DataFrame:
    """The ``k`` nearest rows by inner product of the rows that ``asks``: ``query_id, rank, vec_id, score``.

    ``asks`` is a condition on the column ``id``, the row's ``key``. A row is no neighbour
    of its own id. Vectors that are null, empty or zero, or hold a null or a value that is
    not finite take no part, nor do rows without id; shorter vectors compare as if ended by
    zeros. Rows that repeat id and vector count once; an id with several vectors has the
    better product and one list, which may be short if such ids crowd it. Ties go to the smaller id, and lists are shorter where
    there are fewer rows. An empty table gives no rows; other columns are ignored.

    The result is approximate: vectors are found by prefixes, and at least ``recall`` of
    the neighbours are expected (a sample of queries is compared with every vector).
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    nodes = vector_classes(rows, k + 1)
    facts = nodes.agg(F.max(F.size("vec")), F.count(F.lit(1))).first()
    form = "query_id long, rank int, vec_id long, score double"
    if not facts[1]:
        return spark.createDataFrame([], form)
    width = facts[0]
    members = cut_lineage(
        rows.filter(asks).distinct().join(nodes.select("node", "vec"), "vec").select(F.col("id").alias("query_id"), F.col("node").alias("query")),
        "forest-members",
    )
    queries = cut_lineage(nodes.join(members.select(F.col("query").alias("node")).distinct(), "node"), "forest-queries")
    planes = fit_planes(nodes, width, seed)
    enough = fit_candidates(nodes, queries, planes, width, k, recall, seed)
    blocks = sorted_arrays(nodes, queries, planes, width)
    looks = cut_lineage(_ascended(blocks, enough), "forest-looks")
    # A block that many queries look at is compared in several tasks.
    shares = looks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PROBES).cast("int").alias("shares"))
    strings = queries.select("node", "first", "vec").mapInArrow(_hashed(planes, width, True), _entry_form(nodes)).select(F.col("node").alias("query"), "tree", "hash", "vec")
    probes = (
        looks.withColumn("tree", (F.col("block") % TREES).cast("int")).join(strings, ["query", "tree"]).join(shares, "block")
        .withColumn("share", F.pmod(F.xxhash64("query"), F.col("shares")).cast("int")).select("block", "share", "query", "level", "hash", "vec")
    )
    arrays = blocks.join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    arrays = arrays.select("block", "share", "hashes", "nodes", "firsts", "vectors")
    compared = probes.groupBy("block", "share").cogroup(arrays.groupBy("block", "share")).applyInPandas(
        _compared(width, k + 1, _numbers(nodes)), "query long, node long, first long, score double"
    )
    found = compared.groupBy("query", "node", "first").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first", "node")
    top = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    near = top.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    near = near.groupBy("query", "vec_id").agg(F.min(-F.col("score")).alias("far"))
    lists = near.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("far", "vec_id"))), 1, k + 1).alias("near"))
    listed = members.join(lists, "query").select("query_id", F.explode("near").alias("near")).select("query_id", "near.*")
    listed = listed.filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("far").alias("far"))
    ranked = Window.partitionBy("query_id").orderBy("far", "vec_id")
    ranks = listed.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return ranks.select(
        F.col("query_id").cast("long").alias("query_id"), "rank", F.col("vec_id").cast("long").alias("vec_id"), (-F.col("far")).alias("score")
    )
