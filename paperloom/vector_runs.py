"""A vector history kept as runs: appended by commits, resumed from a ledger, compacted.

::

    runs/run=<r>/part=<p>/model_key=<k>/year=<y>/*.parquet   written once, never changed
    commits/<n>.json                                         live runs: place in the history, parts
    ledger/<r>/                                              work and finished slices of an encoding run

A run becomes visible by a commit, which gives it its place ``seq``: two runs cannot take
the same one, and a run that dies before is not seen. Compaction replaces the runs it has
read by one that holds the newest row of each paper and model; runs appended meanwhile stay.
The driver handles one entry for each live run and part; compaction bounds their number.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.files import ConcurrentChange, commit_file, commit_json, commit_numbers, names_in, read_json, remove
from paperloom.schema import VECTOR_SCHEMA

_STORED = [f for f in VECTOR_SCHEMA if f.name not in ("model_key", "year")]
KEYS = ("id", "year", "model_key")


def create_runs(spark: SparkSession, root: str) -> None:
    """Make an empty history of runs; an existing one is an error."""
    if is_runs(spark, root) or not commit_json(spark, f"{root}/commits", 0, {"live": {}}):
        raise ValueError(f"{root} is a history of runs already")


def is_runs(spark: SparkSession, root: str) -> bool:
    return bool(commit_numbers(spark, f"{root}/commits"))


def live_runs(spark: SparkSession, root: str) -> tuple[int, dict[str, dict]]:
    """Number of the newest commit, and its runs with ``seq`` and ``parts``."""
    number = commit_numbers(spark, f"{root}/commits")[-1]
    return number, read_json(spark, commit_file(f"{root}/commits", number))["live"]


def new_run() -> str:
    return f"r-{uuid.uuid4().hex}"


def write_part(vectors: DataFrame, root: str, run: str, part: str, stored_seq: bool = False) -> None:
    """Write rows of a run that no commit names yet; columns of the vector schema they lack are null."""
    columns = [
        (F.col(f.name) if f.name in vectors.columns and (f.name != "seq" or stored_seq) else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in _STORED
    ]
    rows = vectors.select(*columns, "model_key", "year")
    rows.write.mode("overwrite").partitionBy("model_key", "year").option("compression", "zstd").parquet(f"{root}/runs/run={run}/part={part}")


def publish(spark: SparkSession, root: str, run: str, parts: Iterable[str], replaced: Iterable[str] = (), seq: int | None = None) -> int:
    """Make parts of a run visible in place of the runs ``replaced``. Returns the run's ``seq``.

    A run that is live already keeps its place and gains the parts. Without ``replaced``
    other writers' commits are no conflict: the commit is made again after theirs.
    """
    gone = set(replaced)
    while True:
        number, live = live_runs(spark, root)
        if not gone <= live.keys():
            raise ConcurrentChange(f"runs of {root} that were read are not live any more")
        known = live.get(run, {"seq": number + 1 if seq is None else seq, "parts": []})
        entry = {"seq": known["seq"], "parts": sorted({*known["parts"], *parts})}
        if commit_json(spark, f"{root}/commits", number + 1, {"live": {r: e for r, e in live.items() if r not in gone} | {run: entry}}):
            return entry["seq"]


def append_run(vectors: DataFrame, root: str, run: str | None = None) -> int:
    """Write long vector rows as a run and make it visible. Returns its ``seq``."""
    run = run or new_run()
    write_part(vectors, root, run, "p-all")
    return publish(vectors.sparkSession, root, run, ["p-all"])


def _scan(spark: SparkSession, root: str, runs: dict[str, dict]) -> DataFrame | None:
    paths = [f"{root}/runs/run={r}/part={p}" for r, e in sorted(runs.items()) for p in e["parts"]]
    paths = [p for p in paths if any(n.startswith("model_key=") for n in names_in(spark, p))]
    if not paths:
        return None
    rows = spark.read.schema(VECTOR_SCHEMA).option("basePath", f"{root}/runs").parquet(*paths)
    places = F.create_map(*[F.lit(x) for r, e in runs.items() for x in (r, e["seq"])])
    return rows.withColumn("seq", F.coalesce(F.col("seq"), F.element_at(places, F.col("run")).cast("long")))


def read_runs(spark: SparkSession, root: str, runs: Iterable[str] | None = None) -> DataFrame:
    """Rows of all live runs, or of some of them, in the vector schema; no other run's files are opened."""
    _, live = live_runs(spark, root)
    wanted = live if runs is None else {r: live[r] for r in runs if r in live}
    rows = _scan(spark, root, wanted)
    return spark.createDataFrame([], VECTOR_SCHEMA) if rows is None else rows.select(*VECTOR_SCHEMA.fieldNames())


def newest_rows(spark: SparkSession, root: str, runs: dict[str, dict] | None = None) -> DataFrame:
    """The newest row of each paper and model, in two phases; a newest row without vector is among them.

    The choice reads keys, place and ``vector_sum`` alone and keeps the file and row of each
    winner; then the winners' vectors are fetched by file and row, by a hash join whose
    build side is the choice. Vectors are neither aggregated nor sorted.
    """
    rows = _scan(spark, root, live_runs(spark, root)[1] if runs is None else runs)
    if rows is None:
        return spark.createDataFrame([], VECTOR_SCHEMA)
    rows = rows.withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
    # At one place a row without vector wins, then the greatest sum, then a fixed row.
    order = F.struct("seq", F.col("vector_sum").isNull().alias("absent"), "vector_sum", "__file", "__row")
    chosen = rows.select(*KEYS, order.alias("place")).groupBy(*KEYS).agg(F.max("place").alias("place"))
    places = chosen.select(F.col("place.__file").alias("__file"), F.col("place.__row").alias("__row"))
    return rows.join(places.hint("shuffle_hash"), ["__file", "__row"]).select(*VECTOR_SCHEMA.fieldNames())


def compact(spark: SparkSession, root: str) -> int:
    """Replace the live runs by one with the newest row of each paper and model. Returns its rows.

    Rows that others hide, and newest rows without vector, are left out: nothing earlier
    is left that they would hide. Files get the size adaptive execution aims at. Runs that
    are appended meanwhile stay and count as later; if another compaction was faster,
    ``ConcurrentChange`` is raised and nothing happens.
    """
    _, live = live_runs(spark, root)
    if not live:
        return 0
    run = new_run()
    rows = newest_rows(spark, root, live).filter(F.col("vector").isNotNull())
    write_part(rows.hint("rebalance", "model_key", "year"), root, run, "p-compact", stored_seq=True)
    publish(spark, root, run, ["p-compact"], replaced=live, seq=max(e["seq"] for e in live.values()))
    return read_runs(spark, root, [run]).count()


def drop_runs(spark: SparkSession, root: str) -> int:
    """Remove all commits but the newest and the runs it does not name. Returns runs removed.

    Readers of earlier commits, and encoding runs that are under way, must have ended.
    """
    number, live = live_runs(spark, root)
    for old in commit_numbers(spark, f"{root}/commits"):
        if old < number:
            remove(spark, commit_file(f"{root}/commits", old))
    dead = [n for n in names_in(spark, f"{root}/runs") if n.removeprefix("run=") not in live]
    for name in dead:
        remove(spark, f"{root}/runs/{name}")
    return len(dead)
