"""Order-insensitive, type-strict comparison of a Spark result with a DuckDB statement."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("float", float(f"{value:.12g}"))
    if isinstance(value, datetime.date):
        return str(value)
    return (type(value).__name__, value)


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    want, got = bag(names, result.fetchall()), bag(df.columns, df.collect())
    out = []
    if want != got:
        out.append(f"rows {sum(got.values())} / {sum(want.values())}")
        out += [f"only spark {r}" for r in list((got - want))[:3]]
        out += [f"only duckdb {r}" for r in list((want - got))[:3]]
    return out
