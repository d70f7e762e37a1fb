"""Compare registered queries with their DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return f"date {v.isoformat()}"
    return v


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "HUGEINT": "hugeint",
}


def spark_result(df):
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, types, rows


def duck_result(con, sql: str):
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    kinds = {c[0]: KINDS.get(str(c[1]), str(c[1]).lower()) for c in cur.description}
    names = sorted(cols)
    at = [cols.index(n) for n in names]
    rows = [tuple(_plain(r[i]) for i in at) for r in cur.fetchall()]
    return names, kinds, rows


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and rows agree."""
    names, types, rows = spark_result(df)
    d_names, d_types, d_rows = duck_result(con, sql)
    out = []
    if names != d_names:
        return [f"columns {names} != {d_names}"]
    bad_types = {n: (types[n], d_types[n]) for n in names if types[n] != d_types[n]}
    if bad_types:
        out.append(f"types {bad_types}")
    a, b = Counter(rows), Counter(d_rows)
    if a != b:
        out.append(f"rows {len(rows)} != {len(d_rows)}" if len(rows) != len(d_rows) else "values")
        out.append(f"spark only {list((a - b).items())[:3]}")
        out.append(f"duckdb only {list((b - a).items())[:3]}")
    return out
