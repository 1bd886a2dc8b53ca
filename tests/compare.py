"""Run a query on Spark and its reference SQL on DuckDB over the same files, and compare the rows."""

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return round(float(v), 6) + 0.0
    return str(v)


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(n).to_pylist() for n in cols]
    rows = [tuple(_value(v) for v in r) for r in zip(*data, strict=True)] if cols else []
    return cols, sorted(rows, key=repr)


def kinds(table):
    out = {}
    for f in table.schema:
        k = str(f.type)
        out[f.name] = {"large_string": "string", "float": "double"}.get(k, k)
    return out


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    a = spark_df.toArrow()
    b = con.execute(sql).to_arrow_table()
    ca, ra = rows_of(a)
    cb, rb = rows_of(b)
    if ca != cb:
        return f"columns {ca} vs {cb}"
    if len(ra) != len(rb):
        return f"{len(ra)} rows vs {len(rb)}"
    diff = [(x, y) for x, y in zip(ra, rb, strict=True) if x != y]
    if diff:
        x, y = diff[0]
        cols = [f"{n}: {u!r} vs {v!r}" for n, u, v in zip(ca, x, y, strict=True) if u != v]
        return f"{len(diff)} of {len(ra)} rows differ, e.g. {cols[:4]} in {x[:4]}"
    ka, kb = kinds(a), kinds(b)
    wrong = {n: (ka[n], kb[n]) for n in ka if ka[n] != kb[n]}
    return f"types {wrong}" if wrong else None
