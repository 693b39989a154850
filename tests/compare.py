"""Run a registered query and its SQL twin and compare rows, as multisets, with columns sorted by name."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 7) + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    return value


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return rows_of(columns, result.fetchall())


def difference(query, sql, spark, connection, sf_dir) -> str:
    """Empty where both agree, else a short account of the difference."""
    columns, rows = spark_rows(query(spark, sf_dir))
    sql_columns, expected = sql_rows(connection, sql)
    if columns != sql_columns:
        return f"columns {columns} / {sql_columns}"
    if rows == expected:
        return ""
    extra, missing = rows - expected, expected - rows
    first = next(iter(extra), None), next(iter(missing), None)
    return f"{sum(rows.values())} rows, expected {sum(expected.values())}; first: {first[0]} / {first[1]}"
