"""Registered queries: each pairs a Spark query with its SQL equivalent.

``run(spark, sf_dir)`` reads the given tables. Queries without SQL are checked against
brute force in ``tests/`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with SQL that gives the same rows."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from queries import (  # noqa: F401
        dedup_union,
        harvest,
        joins_reports,
        merges,
        normalize,
        runs,
        splits,
        streams,
        tables_io,
        vector_history,
        vectors,
        versioned,
        whole_jobs,
    )
