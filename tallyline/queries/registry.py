"""Collection of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Runner = Callable[[SparkSession, str], DataFrame]

# Day the daily reports are made for.
DAY = "2024-01-05"
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_STAMP = "%Y-%m-%d %H:%M:%S.%f"


class Registered(NamedTuple):
    run: Runner
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, so that engines agree on types."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            return F.date_format(column, STAMP).alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema.fields])


def register(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query and the SQL it must agree with, if SQL can say it."""

    def add(run: Runner) -> Runner:
        REGISTRY[name] = Registered(lambda spark, folder: plain(run(spark, folder)), sql)
        return run

    return add
