"""Runs a query on Spark and its oracle on DuckDB and compares the rows without order."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(folder, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if v is None or isinstance(v, (bool, int, str)):
        return v
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


def compare(spark, folder, query, sql):
    df = query(spark, folder)
    got = rows(df.columns, df.collect())
    result = connect(folder).execute(sql)
    want = rows([c[0] for c in result.description], result.fetchall())
    return got, want
