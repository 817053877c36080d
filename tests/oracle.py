"""Compares a query with its SQL on the small tables, without regard to row order."""

import os

ROOT = os.environ.get("TESTDATA_DIR", "/root/testdata")
SF = f"{ROOT}/sf0.001"


def connect():
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(SF)):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def compare(spark, con, query, sql):
    df = query(spark, SF)
    names = sorted(df.columns)
    mine = sorted(tuple(str(r[n]) for n in names) for r in df.collect())
    answer = con.sql(sql)
    assert sorted(answer.columns) == names
    at = [answer.columns.index(n) for n in names]
    theirs = sorted(tuple(str(r[i]) for i in at) for r in answer.fetchall())
    assert mine == theirs
