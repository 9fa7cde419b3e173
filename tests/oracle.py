"""Runs a query and its SQL twin over one folder and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([repr([plain(r[i]) for i in order]) for r in rows])


def compare(spark, sf_dir, query, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names), (df.columns, names)
    assert len(got) == len(want), (len(got), len(want), got[:2], want[:2])
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not bad, bad[:3]
    return len(got)
