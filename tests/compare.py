"""Compare a Spark result with the SQL statement run by DuckDB on the same tables."""

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def differences(df, sql, folder):
    """None when rows, column names and column types agree, else a description."""
    con = duck(folder)
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {n: (t.upper().replace(" ", "") if t.startswith("decimal") else KINDS.get(t, t)) for n, t in df.dtypes}
    if mine != types:
        return f"schema: {mine} / {types}"
    names = sorted(types)
    got = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    cur = con.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    want = Counter(tuple(_plain(v) for v in r) for r in cur.fetchall())
    if got == want:
        return None
    return f"{sum(got.values())} / {sum(want.values())} rows; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
