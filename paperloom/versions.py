"""Yearly tables whose years change by switching one small file.

A versioned table has three folders below its root::

    data/part_version=<v>/year=<y>/part_bucket=<b>/*.parquet   written once, never changed
    manifests/<y>-<v>.json                                     bucket -> version, for one year
    commits/<n>.json                                           year -> manifest, schema, buckets

Papers of a year lie in ``buckets`` parts by the hash of their id, so a batch reads and
replaces only the parts its ids fall in. A writer writes data and manifests under names
nobody reads, then renames one commit file into place; a rename never replaces a file, so
of two writers of one commit number the second sees the first, and goes on from there if
they changed different parts. Readers take the commit with the greatest number and name
its folders, years and buckets, to Spark; the stored schema saves reading footers.

What a driver handles is at most one short entry per year and bucket. The table's file
system must rename atomically without replacing, as HDFS does.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from paperloom.files import ConcurrentChange, commit_file, commit_json, commit_numbers, names_in, read_json, remove, write_json

#: For each year the buckets that are meant; None stands for all of them.
Parts = Mapping[int, frozenset[int] | None]

BUCKETS = 64
_VERSION, _BUCKET = "part_version", "part_bucket"


@dataclass(frozen=True)
class Snapshot:
    """One commit: its number, the table's schema and bucket count, and each year's manifest."""

    number: int
    schema: T.StructType
    buckets: int
    years: dict[int, str]


def bucket_of(key: Column | str, buckets: int) -> Column:
    """The bucket of a paper id."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits that still exist, oldest first."""
    return commit_numbers(spark, f"{root}/commits")


def is_versioned(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is a versioned table."""
    return bool(commits(spark, root))


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """The newest commit, or an older one by its number."""
    if number is None:
        numbers = commits(spark, root)
        if not numbers:
            raise ValueError(f"{root} is not a versioned table")
        number = numbers[-1]
    said = read_json(spark, commit_file(f"{root}/commits", number))
    years = {int(y): name for y, name in said["years"].items()}
    return Snapshot(number, T.StructType.fromJson(said["schema"]), said["buckets"], years)


def live_parts(spark: SparkSession, root: str, at: Snapshot, parts: Parts | None = None) -> dict[tuple[int, int], str]:
    """Version of each live part ``(year, bucket)``; only the manifests of the years in ``parts`` are read."""
    out = {}
    for year, name in at.years.items():
        if parts is None or year in parts:
            wanted = None if parts is None else parts[year]
            for bucket, version in read_json(spark, f"{root}/manifests/{name}").items():
                if wanted is None or int(bucket) in wanted:
                    out[year, int(bucket)] = version
    return out


def create_table(spark: SparkSession, root: str, schema: T.StructType, buckets: int = BUCKETS) -> None:
    """Make an empty versioned table; an existing one is an error.

    ``schema`` has ``id`` and ``year``; columns that later writes bring are added to it.
    More buckets mean smaller parts: one should fit a task well.
    """
    if buckets < 1 or not {"id", "year"} <= set(schema.fieldNames()):
        raise ValueError("a versioned table needs columns id and year and at least one bucket")
    if is_versioned(spark, root) or not _commit(spark, root, Snapshot(0, schema, buckets, {})):
        raise ValueError(f"{root} is a versioned table already")


def _commit(spark: SparkSession, root: str, new: Snapshot) -> bool:
    said = {"schema": new.schema.jsonValue(), "buckets": new.buckets, "years": {str(y): n for y, n in new.years.items()}}
    return commit_json(spark, f"{root}/commits", new.number, said)


def read_table(
    spark: SparkSession, root: str, parts: Parts | None = None, number: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of a versioned table, or only of some parts, at the newest commit or an older one.

    The result names files that no later write touches, so it may be read while the table
    changes, until ``drop_versions`` removes them. Files that lack a column of the table's
    schema, or of ``schema`` if given, have nulls there.
    """
    at = snapshot(spark, root, number)
    schema = schema or at.schema
    live = live_parts(spark, root, at, parts)
    if not live:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/data/{_VERSION}={v}/year={y}/{_BUCKET}={b}" for (y, b), v in sorted(live.items())]
    rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*folders)
    return rows.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def touched_parts(batch: DataFrame, buckets: int) -> dict[int, frozenset[int]]:
    """Parts that the ids of a batch fall in; at most one entry per year and bucket comes to the driver."""
    found: dict[int, set[int]] = {}
    for year, bucket in batch.select("year", bucket_of("id", buckets)).distinct().collect():
        if year is not None:
            found.setdefault(year, set()).add(bucket)
    return {year: frozenset(numbers) for year, numbers in found.items()}


def joined_parts(a: Parts, b: Parts) -> dict[int, frozenset[int] | None]:
    """Parts in either of two sets."""
    out = dict(a)
    for year, buckets in b.items():
        known = out.get(year, frozenset())
        out[year] = None if known is None or buckets is None else known | buckets
    return out


def _evolved(stored: T.StructType, new: T.StructType) -> T.StructType:
    """Stored columns, then new ones; a column keeps its type."""
    fields = {f.name: f for f in stored}
    for field in new:
        known = fields.setdefault(field.name, T.StructField(field.name, field.dataType))
        if known.dataType.simpleString() != field.dataType.simpleString():
            raise ValueError(f"column {field.name} is {known.dataType.simpleString()}, not {field.dataType.simpleString()}")
    return T.StructType(list(fields.values()))


def _write_data(df: DataFrame, root: str, buckets: int) -> tuple[str, int]:
    version = f"v-{uuid.uuid4().hex}"
    seen = Observation("written")
    placed = df.withColumn(_BUCKET, bucket_of("id", buckets)).hint("rebalance", "year", _BUCKET)
    placed = placed.sortWithinPartitions("year", _BUCKET, "id").observe(seen, F.count(F.lit(1)).alias("n"))
    placed.write.partitionBy("year", _BUCKET).option("compression", "zstd").parquet(f"{root}/data/{_VERSION}={version}")
    return version, seen.get["n"]


def _written_parts(spark: SparkSession, root: str, version: str) -> list[tuple[int, int]]:
    folder = f"{root}/data/{_VERSION}={version}"
    found = []
    for year in names_in(spark, folder):
        if year.startswith("year="):
            for bucket in names_in(spark, f"{folder}/{year}"):
                if bucket.startswith(f"{_BUCKET}="):
                    found.append((int(year[5:]), int(bucket[len(_BUCKET) + 1 :])))
    return found


def replace_parts(df: DataFrame, root: str, parts: Parts | None = None, read_at: Snapshot | None = None) -> int:
    """Make ``df`` the content of ``parts`` in one step. Returns rows written.

    Without ``parts`` the years in ``df`` are replaced whole. Rows outside ``parts`` are an
    error. ``df`` may read the parts it replaces: nothing is overwritten, and each row is
    written once. A job that dies before the commit changes nothing. ``read_at`` is the
    commit that ``df`` was computed from, by default the newest one now; if another writer
    has changed one of the parts since, ``ConcurrentChange`` is raised and nothing happens.
    """
    spark = df.sparkSession
    base = read_at or snapshot(spark, root)
    schema = _evolved(base.schema, df.schema)
    version, rows = _write_data(df, root, base.buckets)
    written = _written_parts(spark, root, version)
    if parts is None:
        parts = {year: None for year, _ in written}
    strange = [p for p in written if p[0] not in parts or parts[p[0]] is not None and p[1] not in parts[p[0]]]
    if strange:
        raise ValueError(f"rows of parts {strange[:5]} are not to be replaced")
    if not parts:
        return 0
    before = live_parts(spark, root, base, parts)
    manifests: dict[int, str] = {}
    made_from: dict[int, str | None] = {}
    while True:
        now = snapshot(spark, root)
        if now.number != base.number and live_parts(spark, root, now, parts) != before:
            raise ConcurrentChange(f"parts of years {sorted(parts)} of {root} changed since commit {base.number}")
        for year, wanted in parts.items():
            if year not in manifests or made_from[year] != now.years.get(year):
                made_from[year] = now.years.get(year)
                kept = {} if wanted is None else {
                    b: v for (_, b), v in live_parts(spark, root, now, {year: None}).items() if b not in wanted
                }
                kept |= {b: version for y, b in written if y == year}
                manifests[year] = f"{year}-{version}-{uuid.uuid4().hex[:8]}.json"
                write_json(spark, f"{root}/manifests/{manifests[year]}", {str(b): v for b, v in sorted(kept.items())})
        years = now.years | manifests
        if _commit(spark, root, Snapshot(now.number + 1, _evolved(now.schema, schema), now.buckets, years)):
            return rows


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove commits but the newest ``keep``, and the files that only they name. Returns folders removed.

    Readers of older commits, and writers that are under way, must have ended.
    """
    if keep < 1:
        raise ValueError("at least one commit has to stay")
    numbers = commits(spark, root)
    manifests: set[str] = set()
    parts: set[tuple[str, int, int]] = set()
    for number in numbers[-keep:]:
        at = snapshot(spark, root, number)
        manifests |= set(at.years.values())
        parts |= {(v, y, b) for (y, b), v in live_parts(spark, root, at).items()}

    for number in numbers[:-keep]:
        remove(spark, commit_file(f"{root}/commits", number))
    for name in set(names_in(spark, f"{root}/manifests")) - manifests:
        remove(spark, f"{root}/manifests/{name}")
    removed = 0
    for folder in names_in(spark, f"{root}/data"):
        version = folder.removeprefix(f"{_VERSION}=")
        dead = [p for p in _written_parts(spark, root, version) if (version, *p) not in parts]
        if len(dead) == len(_written_parts(spark, root, version)):
            remove(spark, f"{root}/data/{folder}")
        else:
            for year, bucket in dead:
                remove(spark, f"{root}/data/{folder}/year={year}/{_BUCKET}={bucket}")
        removed += len(dead)
    return removed
