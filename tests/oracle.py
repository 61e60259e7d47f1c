"""Spark queries against DuckDB on the same Parquet tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, datetime.datetime):
        return (v.astimezone(datetime.timezone.utc).replace(tzinfo=None) if v.tzinfo else v).isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())


def rows_of_sql(c, sql):
    r = c.sql(sql)
    at = sorted(range(len(r.columns)), key=lambda i: r.columns[i])
    return sorted(r.columns), sorted(tuple(plain(x[i]) for i in at) for x in r.fetchall())
