"""Runs a registered query and its SQL and compares the rows regardless of order."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def oracle_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, [tuple(row) for row in result.fetchall()]


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else repr(value)
        return str(value)

    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    names, rows = canonical(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    expected_names, expected = canonical(*oracle_rows(connection, sql))
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            return f"{got} != {want}"
    return None
