"""Keyed stream of real changes: the newest version of each paper, told once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paperloom.operators.dedup import row_hash

_HASH = "__hash"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newer(order: str | None, content: int, old: Row | None) -> bool:
    """Whether a version replaces the one known: other content, and not an earlier date.

    A missing date is the least, and at equal dates the version that comes later wins, as
    in ``merge_increment``.
    """
    if old is None:
        return True
    known, known_hash = old
    if content == known_hash:
        return False
    return known is None or order is not None and order >= known


class LatestVersion(StatefulProcessor):
    """Holds date and content hash of each key's newest version; passes a row on when they change.

    The rows of a key in one micro-batch are walked once, and at most one of them, the
    newest, is passed on. Of rows with one date the greatest hash wins, so that their
    order does not matter.
    """

    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latest", "version string, content bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if key[0] is None:  # rows that are no paper, such as malformed records, are not told apart
            yield from rows
            return
        best = None
        for row in rows:
            place = (row[self.order] is not None, row[self.order] or "", row[_HASH])
            if best is None or place > best[0]:
                best = (place, row)
        old = self.state.get() if self.state.exists() else None
        row = best[1]
        if newer(row[self.order], row[_HASH], old):
            self.state.update((row[self.order], row[_HASH]))
            yield row
        elif old[1] == row[_HASH] and row[self.order] is not None and (old[0] is None or row[self.order] > old[0]):
            self.state.update((row[self.order], row[_HASH]))

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.state.update((initialState[self.order], initialState[_HASH]))

    def close(self) -> None:
        pass


@contextmanager
def disk_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, on disk."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def changed_versions(
    stream: DataFrame,
    keys: Sequence[str] = ("id",),
    order: str = "updated",
    content: Sequence[str] | None = None,
    known: DataFrame | None = None,
    shards: int = 1,
) -> DataFrame:
    """Rows of a stream that are new or change what was told of their key before.

    Redelivered rows, late rows and rows that only repeat a version are dropped here, by
    state of a date and a hash a key that never expires, and so reach no table. Rows whose
    first key is null pass. ``content`` names the columns that are compared, by default all.
    ``known`` gives the versions that a table holds when the stream starts. With ``shards``
    a key's rows are first thinned in so many tasks, which a stream with a few very
    frequent keys needs.

    Start the stream inside ``disk_state``.
    """
    columns = list(content or stream.columns)
    out = stream.withColumn(_HASH, row_hash(stream.select(*columns)))
    schema = out.schema
    if shards > 1:
        # Neither key nor content may choose the shard: both may be one that is very frequent.
        spread = out.withColumn("__shard", F.floor(F.rand(1) * shards).cast("int"))
        out = spread.groupBy(*keys, "__shard").transformWithState(
            LatestVersion(order), spread.schema, "Append", "None"
        ).drop("__shard")
    initial = None
    if known is not None:
        stored = known.select(*dict.fromkeys([*keys, order, *columns]))
        initial = stored.withColumn(_HASH, row_hash(stored.select(*columns))).select(*keys, order, _HASH).groupBy(*keys)
    return out.groupBy(*keys).transformWithState(LatestVersion(order), schema, "Append", "None", initialState=initial).drop(_HASH)
