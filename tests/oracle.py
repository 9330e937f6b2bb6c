"""Side-by-side comparison of a Spark result and its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, int):
        return value
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(_plain(row[k]) for k in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences between a Spark frame and a SQL result; empty if equal."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    types = {d[0]: str(d[1]) for d in expected.description}
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    for name, kind in df.dtypes:
        if kinds.get(types[name], "?" + types[name]) != kind:
            found.append(f"type of {name}: {kind} against {types[name]}")
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql_rows = _rows(names, expected.fetchall())
    if spark_rows != sql_rows:
        only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
        found.append(
            f"{sum(spark_rows.values())} rows against {sum(sql_rows.values())}; only in Spark "
            f"{sum(only_spark.values())}: {[str(r)[:300] for r in list(only_spark)[:2]]}; only in SQL "
            f"{sum(only_sql.values())}: {[str(r)[:300] for r in list(only_sql)[:2]]}"
        )
    if not spark_rows:
        found.append("no rows")
    return found
