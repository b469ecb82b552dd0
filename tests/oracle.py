"""Runs a query and its SQL on the same tables and compares the rows, whatever their order."""

import glob
import math
import os

SF = "/root/testdata/sf0.001"


def connection(sf=SF):
    import duckdb

    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in found)


def same(spark, c, query, sql, sf=SF):
    df = query(spark, sf)
    got = rows(df.columns, df.collect())
    r = c.sql(sql)
    assert got == rows(r.columns, r.fetchall())
