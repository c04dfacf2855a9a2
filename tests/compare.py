"""Rows of a query against rows of its DuckDB SQL on the same Parquet tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int | float) or hasattr(value, "__float__"):
        return f"{float(value):.7g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.sql(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    want = con.sql(sql)
    names, expected = rows_of(want.columns, want.fetchall())
    df = query(spark, sf_dir)
    got_names, got = rows_of(df.columns, df.collect())
    assert got_names == names
    assert len(got) == len(expected)
    assert got == expected
