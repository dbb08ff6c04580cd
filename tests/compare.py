"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import contextlib
import datetime
import decimal
import io
import math
from collections import Counter

import duckdb


def connect(folder: str, tables: list[str]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def counted(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} instead of {sorted(names)}")
        return found
    spark_kinds = dict(df.dtypes)
    for name in names:
        pair = (spark_kinds[name].split("(")[0], kinds[name].split("(")[0].lower())
        same = {
            ("bigint", "bigint"), ("int", "integer"), ("string", "varchar"), ("double", "double"), ("date", "date"),
            ("timestamp_ntz", "timestamp"), ("timestamp", "timestamp"), ("decimal", "decimal"), ("boolean", "boolean"),
            ("bigint", "number"), ("int", "number"), ("double", "number"), ("string", "string"),
            ("timestamp_ntz", "datetime"), ("date", "datetime"), ("decimal", "number"),
        }
        if pair not in same:
            found.append(f"{name}: {pair}")
    got = counted(df.columns, (tuple(r) for r in df.collect()))
    want = counted(names, result.fetchall())
    if got != want:
        found.append(
            f"{sum(got.values())} rows instead of {sum(want.values())}; "
            f"extra {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
        )
    return found
