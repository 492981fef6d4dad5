"""Compare Spark results with DuckDB results, as rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v == int(v) else round(v, 9))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    table = df.toArrow()
    columns = [table[n].to_pylist() for n in names]
    return names, Counter(tuple(plain(v) for v in row) for row in zip(*columns))


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
