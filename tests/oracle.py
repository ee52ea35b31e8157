"""Run a query in Spark and its SQL in DuckDB on the same files and compare whole results."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(type(v)), str(v)) for v in row)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=key)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(df, sql, con):
    """None when equal, else a text that shows the first difference."""
    got = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if kinds != dict(df.dtypes):
        return f"types {sorted(dict(df.dtypes).items())} != {sorted(kinds.items())}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(_rows(df.columns, got), _rows(names, want)):
        if a != b:
            return f"{sorted(names)}\n  spark  {a}\n  duckdb {b}"
    return None
