"""Runs a query in Spark and its SQL in DuckDB over the same tables and compares them as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
            return str(v)
        return round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def duck(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def differences(df, sql: str, con) -> tuple[list, list]:
    names = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*names).collect())
    rel = con.sql(sql)
    have = rel.columns
    assert sorted(have) == names, (sorted(have), names)
    order = [have.index(n) for n in names]
    want = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    return list((got - want).items())[:4], list((want - got).items())[:4]
