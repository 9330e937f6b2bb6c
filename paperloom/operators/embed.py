"""Running an encoder over texts, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from paperloom.functions.text import embed_text
from paperloom.functions.vectors import repair, vector_sum

# An encoder maps a list of texts to a list of vectors. The factory builds it inside the
# Python worker, once per Spark task; it may memoise a heavy model in its own module.
Encoder = Callable[[list[str]], Sequence[Sequence[float]]]
EncoderFactory = Callable[[], Encoder]

# Fixed value: texts handed to an encoder at once.
BATCH_SIZE = 64

# Start of the error of every row whose encoder could not be built.
NOT_STARTED = "encoder could not be started"


def hash_encoder(dim: int) -> EncoderFactory:
    """Stand-in encoder without a model: bytes of the text's MD5 digest, scaled to [0, 1]."""

    def factory() -> Encoder:
        import hashlib

        def encode(texts: list[str]) -> list[list[float]]:
            digests = [hashlib.md5(t.encode("utf-8")).digest() for t in texts]
            return [[d[i % 16] / 255 for i in range(dim)] for d in digests]

        return encode

    return factory


def embed(
    df: DataFrame,
    factory: EncoderFactory,
    dim: int,
    keys: Sequence[str] = ("id", "year"),
    text: str = "text",
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """One output row per input row: ``keys``, ``vector``, ``error``, ``vector_sum``.

    A text the encoder returned no vector for, or one of the wrong length, gets an
    all-NaN vector, and so does every text of a batch on which the encoder raised;
    ``error`` says why. ``partitions`` spreads the rows round robin, so equal ids or long
    years do not gather in one task. The keys pass through Python as Arrow columns that
    are never turned into objects.
    """
    rows = df.select(*keys, F.col(text).alias("__text"))
    if partitions:
        rows = rows.repartition(partitions)
    schema = T.StructType([
        *rows.select(*keys).schema.fields,
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("error", T.StringType()),
    ])
    names, not_started = schema.fieldNames(), NOT_STARTED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            encode, broken = factory(), None
        except Exception as exc:
            encode, broken = None, f"{not_started}: {exc}"
        for arrow in batches:
            for at in range(0, arrow.num_rows, batch_size):
                part = arrow.slice(at, batch_size)
                texts = part.column(part.num_columns - 1).to_pylist()
                found, problem = [], broken
                if encode is not None:
                    try:
                        found = [np.asarray(v, dtype=np.float32) for v in encode(texts)]
                    except Exception as exc:
                        found, problem = [], f"encoder failed: {exc}"
                flat, lengths, errors = [], [], []
                for k in range(len(texts)):
                    size = found[k].size if k < len(found) else 0
                    good = size == dim and found[k].ndim == 1
                    errors.append(problem or (None if good else f"vector length {size} is not {dim}"))
                    lengths.append(dim if good else 0)
                    if good:
                        flat.append(found[k])
                values = np.concatenate(flat) if flat else np.empty(0, np.float32)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.float32()))
                # Copies: whoever holds a part that was handed out does not hold the whole Arrow batch with it.
                own = pa.array(np.arange(len(texts)))
                kept = [part.column(k).take(own) for k in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, vectors, pa.array(errors, pa.string())], names=names)
            # Let go before the next Arrow batch is read, so that a task holds one at a time.
            arrow = part = texts = kept = None

    raw = rows.mapInArrow(run, schema)
    fixed = raw.withColumn("vector", repair("vector", dim))
    return fixed.withColumn("vector_sum", vector_sum("vector"))


def embed_table(
    papers: DataFrame,
    factory: EncoderFactory,
    key: str,
    dim: int,
    title: str = "title",
    abstract: str = "abstract",
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Embed every row of a table and keep all its columns; ``key`` is replaced or appended last.

    The columns travel beside the text through the encoder's task, so no join is needed
    to put them back.
    """
    kept = [c for c in papers.columns if c != key]
    rows = papers.select(*kept, embed_text(title, abstract).alias("__embed"))
    done = embed(rows, factory, dim, kept, "__embed", batch_size, partitions)
    return done.select(*kept, F.col("vector").alias(key))
