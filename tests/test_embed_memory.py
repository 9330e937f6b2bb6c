"""What a task of the encoder holds of its Arrow batches."""

import pyarrow as pa
from paperloom.operators.embed import embed, hash_encoder
from pyspark.sql import functions as F

ROWS, WORDS = 1000, 8000


def _batch():
    ids = pa.array([str(k) for k in range(ROWS)])
    return pa.RecordBatch.from_arrays([ids, pa.array(["x" * WORDS] * ROWS), pa.array(["y" * WORDS] * ROWS)], names=["id", "note", "__text"])


def test_an_arrow_batch_is_let_go_before_the_next(spark, monkeypatch):
    df = spark.createDataFrame([("a", "n", "t")], "id string, note string, text string")
    real, held = type(df).mapInArrow, {}

    def seen(self, run, schema, *rest):
        held["run"] = run
        return real(self, run, schema, *rest)

    monkeypatch.setattr(type(df), "mapInArrow", seen)
    embed(df, hash_encoder(4), 4, keys=["id", "note"])
    start, left = pa.total_allocated_bytes(), []

    def batches():
        for _ in range(3):
            left.append(pa.total_allocated_bytes() - start)
            yield _batch()

    rows = 0
    for out in held["run"](batches()):
        rows += out.num_rows
    assert rows == 3 * ROWS and max(left) < ROWS * WORDS / 4


def test_columns_of_any_type_travel_beside_the_text(spark):
    rows = spark.range(150).select(
        "id", F.when(F.col("id") % 3 != 0, F.array(F.col("id"), F.lit(None))).alias("a"), F.struct("id", F.lit("s")).alias("s"),
        F.create_map(F.lit("k"), "id").alias("m"), F.expr("decimal(id)").alias("d"), F.expr("binary(string(id))").alias("b"),
        F.col("id").cast("string").alias("text"),
    )
    keys = ["id", "a", "s", "m", "d", "b"]
    done = embed(rows, hash_encoder(4), 4, keys=keys)
    assert sorted(map(str, done.select(*keys).collect())) == sorted(map(str, rows.select(*keys).collect()))
    assert done.filter("error is not null or size(vector) <> 4").isEmpty()
