"""Compares a query with its SQL: columns sorted by name, rows as a multiset of values."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, datetime.datetime | datetime.date):
        return v.isoformat()
    return v


def _kind(name: str) -> str:
    """Type names of both engines, on one scale."""
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    }
    return same.get(name, name.upper())


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences, none when both agree."""
    names = sorted(spark_df.columns)
    got = Counter(tuple(_value(r[n]) for n in names) for r in spark_df.collect())
    cursor = connection.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    problems = []
    if names != sorted(sql_names):
        return [f"columns {names} != {sorted(sql_names)}"]
    kinds = {d[0]: str(d[1]).upper() for d in cursor.description}
    spark_kinds = {n: _kind(t) for n, t in spark_df.dtypes}
    for n in names:
        if kinds[n] != spark_kinds[n]:
            problems.append(f"type of {n}: {spark_kinds[n]} != {kinds[n]}")
    place = [sql_names.index(n) for n in names]
    want = Counter(tuple(_value(row[i]) for i in place) for row in cursor.fetchall())
    if got != want:
        problems.append(f"rows {sum(got.values())} != {sum(want.values())}" if sum(
            got.values()) != sum(want.values()) else "values differ")
        problems += [f"only spark {r}" for r in list((got - want))[:3]]
        problems += [f"only sql {r}" for r in list((want - got))[:3]]
    return problems
