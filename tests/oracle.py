"""Compare a query with its SQL in DuckDB, as multisets of rows with columns in name order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(df, con, sql):
    cur = con.execute(sql)
    want = rows([c[0] for c in cur.description], cur.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0], (got[0], want[0])
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]), got[1][:2], want[1][:2])
    for a, b in zip(got[1], want[1], strict=True):
        assert a == b, (a, b)
