"""Compare a query with its DuckDB text on the driver's tables."""

import glob
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def _cell(x):
    if isinstance(x, float):
        return None if x != x else round(x, 9)
    return x


def rows(names, found):
    """Rows with columns by name, sorted, floats rounded."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(([_cell(r[k]) for k in order] for r in found), key=repr)


def compare(spark, query, sql, data=DATA):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = query(spark, data)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, cur.fetchall())
