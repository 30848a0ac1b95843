"""Filters, constants, casts and the valid/reject split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _day(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def on_date(
    df: DataFrame,
    timestamp: str,
    date: str | dt.date | Column,
    partition_column: str | None = None,
) -> DataFrame:
    """Rows whose timestamp falls on one day.

    Catalyst turns the cast into a range on the timestamp that reaches the file
    scan. ``partition_column`` names a date partition to prune folders as well.
    """
    rows = df.filter(F.to_date(timestamp) == _day(date))
    return rows.filter(F.col(partition_column) == _day(date)) if partition_column else rows


def only_active(df: DataFrame, flag: str, value: object = True) -> DataFrame:
    """Rows whose active flag holds the value (``True`` or a letter)."""
    return df.filter(F.col(flag) == F.lit(value))


def status_in(df: DataFrame, statuses: Sequence[str], column: str = "status") -> DataFrame:
    return df.filter(F.col(column).isin(*statuses))


def having(summary: DataFrame, measure: str, above: float = 0) -> DataFrame:
    """Groups whose measure exceeds the bound."""
    return summary.filter(F.col(measure) > above)


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )


def default_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def to_target(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of the target that the frame has, in target order and type."""
    return df.select(
        *[F.col(f.name).cast(f.dataType) for f in target.fields if f.name in df.columns]
    )


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns whose expressions are evaluated once per row.

    Catalyst copies a projected expression into every filter pushed below the
    projection. For dear expressions, such as patterns over long text, that
    repeats the work many times; a generator that yields one row stops it.
    """
    kept = [c for c in df.columns if c not in columns]
    once = F.inline(F.array(F.struct(*[v.alias(name) for name, v in columns.items()])))
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    return df.select(*kept, once).select(*order)


def split_by_reason(
    df: DataFrame, reason: Column, name: str = "reject_reason"
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reason."""
    judged = computed_once(df, {name: reason})
    valid = judged.filter(F.col(name).isNull()).drop(name)
    return valid, judged.filter(F.col(name).isNotNull())


def visible_rows(
    df: DataFrame,
    access_level: str | None,
    column: str = "data_classification",
    hidden: str = "CONFIDENTIAL",
) -> DataFrame:
    """Restricted readers see classified rows other than the hidden class.

    A row without classification is hidden from them as well.
    """
    return df.filter(F.col(column) != hidden) if access_level == "RESTRICTED" else df


def within_retention(
    df: DataFrame, as_of: Column | None = None, column: str = "retention_date"
) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    return df.filter(F.col(column) >= today)
