"""Compares a query's rows with those of its SQL oracle, as sorted multisets with columns by name."""

import datetime
import decimal
import os

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{sf}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(map(plain, x.values()))
    if isinstance(x, decimal.Decimal):
        return int(x) if x == int(x) else float(x)
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    return x


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(plain(r[i])) for i in order) for r in found))


def differences(spark, query, sql, sf="sf0.001", con=None):
    """A list of complaints; empty if query and oracle agree."""
    df = query(spark, f"{DATA}/{sf}")
    got = rows(df.columns, df.collect())
    found = (con or connect(sf)).execute(sql)
    names = [d[0] for d in found.description]
    want = rows(names, found.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    if len(got) != len(want):
        out.append(f"{len(got)} rows against {len(want)}")
    if got != want:
        a, b = set(got), set(want)
        out.append(f"only here {sorted(a - b)[:3]}; only in the oracle {sorted(b - a)[:3]}")
    return out


def exists(sf):
    return os.path.isdir(f"{DATA}/{sf}")
