"""Compare one query with its SQL answer, order-insensitively and exactly."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row[n] for n in names) for row in df.collect())


def rows_of_sql(connection, text: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(text)
    columns = [d[0] for d in cursor.description]
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return sorted(columns), Counter(tuple(row[i] for i in places) for row in rows)


def differences(df, connection, text: str) -> str:
    """Empty if both give the same columns and rows."""
    names, got = rows_of_spark(df)
    wanted_names, wanted = rows_of_sql(connection, text)
    if names != wanted_names:
        return f"columns {names} / {wanted_names}"
    if got == wanted:
        return ""
    extra, missing = got - wanted, wanted - got
    return (
        f"rows {sum(got.values())} / {sum(wanted.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )
