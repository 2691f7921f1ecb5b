"""Compare a Spark result with the DuckDB result of the same query."""

import math

import duckdb

from granary.registry.base import TABLES


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return f"{type(value).__name__}:{value}"


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(frame, relation):
    """A short description of how two results differ, None when they are equal."""
    columns, expected = frame.columns, relation.columns
    if sorted(columns) != sorted(expected):
        return f"columns {sorted(columns)} != {sorted(expected)}"
    got = _sorted(columns, [tuple(r) for r in frame.collect()])
    want = _sorted(expected, relation.fetchall())
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return (f"{len(got)} rows != {len(want)}; only in Spark {sorted(extra)[:3]}; "
            f"only in SQL {sorted(missing)[:3]}; columns {sorted(columns)}")
