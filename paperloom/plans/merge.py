"""Merging batches into the yearly table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from paperloom.functions.dates import TIMESTAMP_FORMAT
from paperloom.operators.align import united
from paperloom.operators.dedup import keep_last, latest, without_keys
from paperloom.operators.upsert import changed_rows, matched, replaced_keys
from paperloom.operators.years import split_valid, with_year
from paperloom.schema import PAPER_COLUMNS, ModelSpec
from paperloom.session import cut_lineage, scoped
from paperloom.sinks.tables import replace_touched, replace_years, write_artifacts
from paperloom.sources.tables import has_year, is_table, next_seq, read_touched, read_years, table_state, touched
from paperloom.versions import Parts, Snapshot, is_versioned, joined_parts, read_table

KEYS = ("id", "year")


def upserted(
    existing: DataFrame,
    batch: DataFrame,
    arrival: Sequence[str] = ("seq",),
    models: Mapping[str, ModelSpec] | None = None,
    fill: str = "null",
    existing_keyed: bool = True,
) -> DataFrame:
    """The touched years after an upsert: batch rows beat existing ones, later beat earlier.

    Both sides carry ``year`` and are brought to one schema that keeps every column of
    either side. ``arrival`` orders the batch; those of its columns that the table does
    not have are dropped. A batch row that only repeats the stored one changes nothing,
    so columns the batch lacks, such as vectors, stay.
    """
    newest = keep_last(batch, KEYS, arrival)
    if not existing_keyed:
        existing = keep_last(existing, KEYS, ())
    changed = changed_rows(existing, _stored_columns(newest, existing, arrival), KEYS)
    return _put(changed, existing, models, fill)


def _stored_columns(newest: DataFrame, stored: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """A batch without arrival columns that are not stored."""
    return newest.drop(*[c for c in arrival if c not in stored.columns])


def _put(changed: DataFrame, stored: DataFrame, models: Mapping[str, ModelSpec] | None, fill: str) -> DataFrame:
    """Stored rows with the changed rows in place of theirs, in one schema."""
    old, new = united(without_keys(stored, changed, KEYS), changed, models, fill)
    return old.unionByName(new)


@dataclass(frozen=True)
class UpsertResult:
    years: list[int]
    rows_written: int
    rows_invalid: int


@scoped
def upsert_years(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    quarantine: str | None = None,
    quarantine_mode: str = "append",
    rule: str | int = "created",
    formats: tuple[str, ...] = (TIMESTAMP_FORMAT,),
    arrival: Sequence[str] = (),
    models: Mapping[str, ModelSpec] | None = None,
    fill: str = "null",
    vectors_root: str | None = None,
    seq: int | None = None,
    move: bool = False,
) -> UpsertResult:
    """Assign years to a batch and upsert them into the table at ``root``.

    Only the years in the batch are read and rewritten, of a versioned table only the parts
    its ids fall in. A row that only repeats the stored one changes nothing: what the batch
    does not carry, such as vectors, stays. Rows without a year are counted, and written to
    ``quarantine`` if given. With ``vectors_root``, papers whose content
    the batch changes lose their vectors of ``models`` there; ``seq`` is this run's place
    in the vector history, by default the next free one.

    With ``move`` a paper has one year: the last row of its id counts, and its rows in other
    years go. They are found by the ids alone, in the parts of all years that the batch's
    ids fall in, so this takes a versioned table.
    """
    if move and is_table(spark, root) and not is_versioned(spark, root):
        raise ValueError("papers move between the years of a versioned table only")
    valid, invalid = split_valid(with_year(batch, rule, formats))
    newest = cut_lineage(keep_last(valid, ("id",) if move else KEYS, arrival), "upsert-batch")
    rows_invalid = _set_aside(invalid, quarantine, quarantine_mode) if quarantine else invalid.count()
    state = table_state(spark, root)
    parts = touched(newest, state)
    years = sorted(parts)
    if not years:
        return UpsertResult([], 0, rows_invalid)
    if is_table(spark, root):
        moved = _other_years(spark, newest, root, parts, state) if move and state else None
        if moved is not None:
            parts = joined_parts(parts, touched(moved, state))
            years = sorted(parts)
        stored = read_touched(spark, root, parts, state)
        if moved is not None:
            stored = without_keys(stored, moved, KEYS)
        if vectors_root and models:
            metadata = stored.select(*[c for c in stored.columns if c not in models])
            changed = replaced_keys(metadata, newest.drop(*models), KEYS)
            forget_vectors(changed, list(models), vectors_root, next_seq(spark, vectors_root) if seq is None else seq)
        changed = cut_lineage(changed_rows(stored, _stored_columns(newest, stored, arrival), KEYS), "changed")
        merged = _put(changed, stored, models, fill)
    else:
        # Columns that only tell arrivals apart are not stored; a paper's own are, whatever else they serve for.
        merged = newest.drop(*[c for c in arrival if c not in PAPER_COLUMNS])
    return UpsertResult(years, replace_touched(merged, root, parts, state), rows_invalid)


def _other_years(spark: SparkSession, newest: DataFrame, root: str, parts: Parts, state: Snapshot) -> DataFrame | None:
    """Stored ``id, year`` of a batch's papers in years other than the batch's; None if there are none."""
    buckets = frozenset().union(*parts.values())
    stored = read_table(spark, root, {y: buckets for y in state.years}, state.number)
    told = newest.select("id", F.col("year").alias("__year"))
    found = stored.select("id", "year").join(told, "id").filter(F.col("year") != F.col("__year")).select("id", "year")
    found = cut_lineage(found.distinct(), "moved")
    return None if found.isEmpty() else found


def _set_aside(invalid: DataFrame, quarantine: str, mode: str) -> int:
    # Counted in the writing stage itself, where a retried task is not counted twice.
    seen = Observation("invalid")
    invalid.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(quarantine)
    return seen.get["n"]


@dataclass(frozen=True)
class MergeResult:
    rows_written: int
    inserted: int
    updated: int
    unchanged: int
    net_growth: int


@scoped
def merge_increment(
    spark: SparkSession,
    increment: DataFrame,
    root: str,
    year: int,
    nulls: str = "last",
    vectors_root: str | None = None,
    models: Mapping[str, ModelSpec] | None = None,
    seq: int | None = None,
) -> MergeResult:
    """Merge an increment into one year, keeping the row with the latest ``updated`` per id.

    A year that does not exist yet becomes the deduplicated increment. A row that only
    repeats what is stored changes nothing; one that differs at an equal ``updated`` wins.
    With ``vectors_root``, papers whose row was replaced lose their vectors of ``models``,
    so that they are embedded again; ``seq`` is this run's place in the vector history,
    by default the next free one.

    The increment is cut to one row per id first. The stored year, or the parts of a
    versioned table that its ids fall in, is read once to compare metadata and once to be
    written.
    """
    newest = latest(with_year(increment, year), KEYS, nulls=nulls)
    if not has_year(spark, root, year):
        rows = replace_years(newest, root)
        return MergeResult(rows, rows, 0, 0, rows)
    newest = cut_lineage(newest, "increment")
    state = table_state(spark, root)
    parts = touched(newest, state)
    stored = read_touched(spark, root, parts, state)
    met = cut_lineage(matched(stored, newest, KEYS, "updated", nulls), "matched")
    replacing = met.filter("__wins").drop("__wins")
    added = without_keys(newest, met, KEYS)
    inserted, updated = added.count(), replacing.count()
    result = MergeResult(0, inserted, updated, read_years(spark, root, [year]).count() - updated, inserted)
    if not inserted and not updated:
        return result
    if vectors_root and models and updated:
        forget_vectors(replacing, list(models), vectors_root, next_seq(spark, vectors_root) if seq is None else seq)
    old, new = united(without_keys(stored, replacing, KEYS), replacing.unionByName(added))
    return replace(result, rows_written=replace_touched(old.unionByName(new), root, parts, state))


def forget_vectors(papers: DataFrame, model_keys: Sequence[str], root: str, seq: int) -> None:
    """Append rows without a vector, which hide all earlier vectors of these papers.

    No stored vector is rewritten.
    """
    rows = papers.select(
        "id",
        "year",
        F.explode(F.array(*[F.lit(k) for k in model_keys])).alias("model_key"),
        F.lit(None).cast("array<float>").alias("vector"),
        F.lit(None).cast("double").alias("vector_sum"),
        F.lit(seq).cast("bigint").alias("seq"),
    )
    write_artifacts(rows, root)
