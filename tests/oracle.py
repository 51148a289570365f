"""Runs queries of __spark_entry__ beside their SQL in DuckDB."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    return x.isoformat() if hasattr(x, "isoformat") else str(x) if isinstance(x, list | dict) else x


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(str(plain(r[k])) for k in order) for r in found)


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = connect(sf_dir).execute(sql)
    want = rows([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0], (name, got[0], want[0])
    assert len(got[1]) == len(want[1]), (name, len(got[1]), len(want[1]))
    assert got[1] == want[1], (name, [x for x in zip(got[1], want[1]) if x[0] != x[1]][:3])
