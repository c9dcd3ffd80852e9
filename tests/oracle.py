"""Runs a registered query and its SQL side by side."""

import math
import os
from collections import Counter

import duckdb


def plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "tolist") and not isinstance(v, str):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v)[:19] if hasattr(v, "isoformat") else v


def compare(spark, query, sql, folder):
    con = duckdb.connect()
    for p in os.listdir(folder):
        full = os.path.join(folder, p)
        con.execute(f"create view {p.split('.')[0]} as select * from '{full + '/*.parquet' if os.path.isdir(full) else full}'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
