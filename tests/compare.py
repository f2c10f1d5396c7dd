"""Compare a Spark query with its SQL: column names, row count, and values."""

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "is_finite"):  # decimal
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def differences(con, df, sql):
    """Empty when both agree, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(names)}"
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return ""
    a, b = got - want, want - got
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; only spark "
        f"{sum(a.values())}: {list(a)[:3]}; only sql {sum(b.values())}: {list(b)[:3]}"
    )
