"""Comparison of a query with its SQL, row by row and without regard to order."""

import glob
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connection(sf=SF):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)]
    cell = lambda x: "None" if x is None or x != x else str(round(x, 6) + 0.0) if isinstance(x, float) else str(x)
    return list(frame.columns), sorted(tuple(cell(x) for x in row) for row in frame.astype(object).itertuples(index=False))


def same(spark_frame, con, sql):
    assert normal(spark_frame.toPandas()) == normal(con.execute(sql).df())
