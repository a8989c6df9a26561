"""Compare registered queries with their SQL on DuckDB."""

import glob
import os

import duckdb

from workload.catalog import QUERIES
from workload.oracles import ORACLES


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {table} as select * from '{path}'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


def both(spark, con, name, sf_dir):
    """(columns, sorted rows) from Spark and from DuckDB."""
    df = QUERIES[name](spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    return ours, theirs
