"""Compare a Spark query with its SQL, values and all."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    found = connection.execute(sql)
    return rows_of([c[0] for c in found.description], found.fetchall())


def kinds(df, connection, sql):
    """Type classes of both sides by column name."""
    spark_kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMPTZ",
    }
    ours = {c: spark_kinds.get(k, k) for c, k in df.dtypes}
    theirs = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return ours, theirs


def difference(df, connection, sql, limit=3):
    """None if equal, else what differs."""
    ours, theirs = kinds(df, connection, sql)
    if ours != theirs:
        wrong = {k: (ours.get(k), theirs.get(k)) for k in {*ours, *theirs} if ours.get(k) != theirs.get(k)}
        return f"types {wrong}"
    (_, a), (_, b) = spark_rows(df), duck_rows(connection, sql)
    if a == b:
        return None
    left, right = set(a) - set(b), set(b) - set(a)
    return f"{len(a)} vs {len(b)} rows; spark only {list(left)[:limit]}; sql only {list(right)[:limit]}"
