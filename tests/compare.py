"""Run a registered query and its SQL, and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_engine(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        value = "nan" if math.isnan(value) else float(f"{value:.12g}")
    return type(value).__name__, value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())
