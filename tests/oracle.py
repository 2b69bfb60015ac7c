"""Compare a Spark result with DuckDB SQL on the same parquet tables.

Columns are matched by name (sorted), rows compared as sorted multisets of
normalised values -- the same shape of check the driver's gate makes. Where
the row order is part of the answer, Spark's rows must also be in it.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return (type(v).__name__, v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, body


def out_of_order(columns, rows, order):
    """Index of the first row that is not in ``order`` ("-" descends; nulls
    first ascending, last descending), or None."""
    keys = [(columns.index(c.lstrip("-")), c.startswith("-")) for c in order.split()]
    for n, (a, b) in enumerate(zip(rows, rows[1:])):
        for i, down in keys:
            x, y = ((v[i] is not None, v[i]) for v in ((b, a) if down else (a, b)))
            if x == y:
                continue
            if x[0] > y[0] or (x[0] and y[0] and x[1] > y[1]):
                return n + 1
            break
    return None


def compare(spark_df, con, sql, order=None):
    got = [tuple(r) for r in spark_df.collect()]
    s_cols, s_rows = canon(spark_df.columns, got)
    rel = con.sql(sql)
    d_cols, d_rows = canon(rel.columns, rel.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b]
        problems.append(f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}")
    if order and (bad := out_of_order(spark_df.columns, got, order)) is not None:
        problems.append(f"row {bad} is not in the order {order!r}")
    return problems, len(s_rows)
