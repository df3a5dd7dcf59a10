"""Compare a registered query with its SQL oracle on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(rows, names):
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    rows = df.collect()
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    got, want = ordered(rows, df.columns), ordered(expected_rows, expected_names)
    if got == want:
        return None
    from collections import Counter

    left, right = Counter(map(repr, got)), Counter(map(repr, want))
    only_left = list((left - right).elements())
    only_right = list((right - left).elements())
    return (
        f"rows {len(got)} vs {len(want)}, differing {len(only_left)}/{len(only_right)}; "
        f"columns {sorted(df.columns)}; spark {only_left[:3]}; sql {only_right[:3]}"
    )
