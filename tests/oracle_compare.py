"""Compare a Spark result with a DuckDB result: row count, column names and
an order-insensitive multiset of rows. Floats must be equal bit for bit
(``digits`` rounds them instead, for ad-hoc checks)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


DIGITS = None


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if DIGITS is None else float(f"{v:.{DIGITS}g}")
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, float)):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    return problems, len(s_rows)
