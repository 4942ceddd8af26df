"""Run a query in Spark and its SQL in DuckDB and compare names, rows and values."""

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, con, sf_dir, run, sql):
    """None when both sides agree, else what differs."""
    df = run(spark, sf_dir)
    ours = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows <> {len(theirs)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first: {wrong[0][0]} <> {wrong[0][1]}"
    return None
