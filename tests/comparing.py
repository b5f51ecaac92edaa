"""Queries beside their SQL on the same tables."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if v != v else round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def duck(folder=DATA):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def same(spark, name, query, sql, folder=DATA):
    df = query(spark, folder)
    got = df.collect()
    cur = duck(folder).execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns), name
    order = sorted(names)
    a = Counter(tuple(plain(r[c]) for c in order) for r in got)
    b = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall())
    assert a == b, (name, list((a - b).items())[:3], list((b - a).items())[:3])
