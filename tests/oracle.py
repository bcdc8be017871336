"""Rows of a query and of its SQL, made comparable."""

import decimal
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    return v


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(folder):
        path = f"{folder}/{f}" + ("/*.parquet" if os.path.isdir(f"{folder}/{f}") else "")
        con.execute(f"create view {f.split('.')[0]} as select * from '{path}'")
    return con


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def rows_of_sql(folder, sql):
    cur = connect(folder).execute(sql)
    got = [d[0] for d in cur.description]
    names = sorted(got)
    return names, sorted((tuple(plain(r[got.index(c)]) for c in names) for r in cur.fetchall()), key=repr)
