"""The prefix forest against brute force: recall where vectors are many, equality where a query sees all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import prefix_forest as pf

NAN, INF = float("nan"), float("inf")


def brute(ids, matrix, asked, k):
    """Best ids of each asked id by (product, smaller id), of rows with other ids."""
    out = {}
    for q in asked:
        score = np.zeros(len(ids))
        for c in range(matrix.shape[1]):
            score += matrix[:, c] * matrix[ids == q][0, c]
        order = np.lexsort((ids, -score))
        out[q] = [(int(ids[j]), float(score[j])) for j in order if ids[j] != q][:k]
    return out


def lists(result):
    out = {}
    for row in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        mine = out.setdefault(row.query_id, [])
        assert row.rank == len(mine) + 1
        mine.append((row.vec_id, row.score))
    return out


@pytest.mark.parametrize("table", ["sf0.01", "check_h"])
def test_recall_against_brute_force(spark, table):
    vectors = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").toPandas()
    ids, matrix = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    asked = ids[ids % 20 == 0]
    got, best = lists(pf.nearest(vectors, F.col("id") % 20 == 0)), brute(ids, matrix, asked, 20)
    assert set(got) == set(best)
    assert all(len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) for q in got)
    truth = {q: dict(best[q]) for q in best}
    assert all(truth[q].get(v, s) == s for q in got for v, s in got[q])
    assert np.mean([len(truth[q].keys() & dict(got[q]).keys()) / 20 for q in best]) >= 0.9


def test_lengths_ties_and_copies(spark):
    """Other lengths, ties, and equal vectors in a third of all rows; a sample of all queries must find everything."""
    random = np.random.default_rng(3)
    matrix = random.standard_normal((300, 8)) * random.lognormal(0, 1, 300)[:, None]
    matrix[::3] = matrix[0]
    ids = np.arange(300) * 5
    table = spark.createDataFrame([(int(i), [float(x) for x in v], "x", 1) for i, v in zip(ids, matrix, strict=True)], "vec_id long, embedding array<double>, node string, rank int")
    got = lists(pf.nearest(table.repartition(7), F.col("id") % 20 == 0, k=7, recall=1.0))
    best = brute(ids, matrix, ids[ids % 20 == 0], 7)
    assert set(got) == set(best)
    found = sum(a in best[q] for q in got for a in got[q])
    assert found >= 0.99 * sum(map(len, best.values()))
    assert all(v != q for q in got for v, _ in got[q])
    copies = {q for q in got if q % 15 == 0}
    assert all(got[q] == best[q] for q in copies)


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (40, [NAN, 1.0]), (60, [INF, 1.0]), (80, [None, 1.0]),
        (None, [1.0, 1.0]), (5, [1.0]), (6, [1.0, 0.0, 0.0]), (7, [-1.0, -0.0]), (8, [0.0, 0.0, 3.0]), (100, None), (9, [3.0, 0.0]), (9, [0.0, 1.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    got = lists(pf.nearest(table, F.col("id") % 20 == 0, k=20))
    assert got == {
        0: [(20, 4.0), (9, 3.0), (5, 1.0), (6, 1.0), (8, 0.0), (7, -1.0)],
        20: [(9, 6.0), (0, 4.0), (5, 2.0), (6, 2.0), (8, 0.0), (7, -2.0)],
    }
    assert pf.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0
    assert pf.nearest(table.filter("vec_id = 20"), F.col("id") % 20 == 0).count() == 0


def test_prefixes():
    a = np.array([0, 1, 1 << 63, (1 << 64) - 1], dtype=np.uint64)
    assert pf._shared_bits(a[:, None], a[None, :]).tolist() == [[64, 63, 0, 0], [63, 64, 0, 0], [0, 0, 64, 1], [0, 0, 1, 64]]
    assert pf._prefix(a, 64).tolist() == a.tolist() and pf._prefix(a, 0).tolist() == [0] * 4
    assert pf._after(pf._prefix(a, 63), 63).tolist() == [1, 1, (1 << 63) + 1, (1 << 64) - 1]
    assert (np.sort(pf._signed(a)) == pf._signed(a)).all() and (pf._unsigned(pf._signed(a)) == a).all()
