"""Row order and physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tallyline.sources.writers import write_path

MORTON_BITS = 8
# Digits of the hexadecimal form of a text that its place in the order is taken from.
_TEXT_DIGITS = 14


def order_by_keys(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Total order. End the keys with a unique column so equal rows can be split."""
    return df.orderBy(*keys)


def partition_by_key(
    df: DataFrame, keys: Sequence[str], num_partitions: int | None = None, split_hot: bool = True
) -> DataFrame:
    """Hash layout by key.

    With ``split_hot`` adaptive execution may spread one hot key over several
    tasks. Switch it off only when each key must sit in exactly one partition.
    """
    if split_hot:
        size = [] if num_partitions is None else [num_partitions]
        return df.hint("rebalance", *size, *keys)
    if num_partitions is None:
        return df.repartition(*keys)
    return df.repartition(num_partitions, *keys)


def clustered_rewrite(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    num_partitions: int | None = None,
) -> DataFrame:
    """Rewrite a table so that each file holds a narrow range of the keys.

    Readers that filter on a leading key then skip most files. End the keys with a
    unique column: equal keys, NULLs and empty text among them, cannot be split between
    files. The ranges are found by sampling, which reads the input once more, so give a
    stored table. ``num_partitions`` is the number of files.
    """
    columns = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(num_partitions, *columns) if num_partitions else df.repartitionByRange(*columns)
    return write_path(ranged.sortWithinPartitions(*keys), path, fmt=fmt)


def _orderable(df: DataFrame, column: str) -> Column:
    """A number in the order of the column; of texts the first seven bytes count."""
    kind = df.schema[column].dataType
    if isinstance(kind, StringType):
        digits = F.rpad(F.hex(F.encode(F.substring(column, 1, _TEXT_DIGITS // 2), "UTF-8")), _TEXT_DIGITS, "0")
        return F.conv(F.substring(digits, 1, _TEXT_DIGITS), 16, 10).cast("double")
    if isinstance(kind, (DateType, TimestampNTZType, TimestampType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if not isinstance(kind, NumericType):
        raise ValueError(f"column {column} of type {kind.simpleString()} has no order to cluster by")
    return F.col(column).cast("double")


def _rank(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the ascending bounds are not above the value, by halving; NULL has rank 0."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle]), among(low, middle)).otherwise(among(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(among(0, len(bounds)))


def morton_code(df: DataFrame, columns: Sequence[str], bits: int = MORTON_BITS) -> Column:
    """A number whose neighbours lie close together in all columns at once.

    Each column is cut at its quantiles into 2^bits ranges of about equally many rows, and
    the bits of the ranges' numbers are interleaved, the highest ones first. The quantiles are
    approximate, from one pass over the columns, and 2^bits - 1 numbers each.
    """
    if bits * len(columns) > 62:
        raise ValueError("bits of all columns must fit into 62")
    parts = [F.lit(k / (1 << bits)) for k in range(1, 1 << bits)]
    found = df.agg(
        *[
            F.percentile_approx(_orderable(df, c), F.array(*parts), F.lit(100 << bits)).alias(f"q{n}")
            for n, c in enumerate(columns)
        ]
    ).first()
    code = F.lit(0).cast("long")
    for n, column in enumerate(columns):
        bounds = sorted(set(found[n] or []))
        rank = _rank(_orderable(df, column), bounds).cast("long")
        for bit in range(bits):
            place = bit * len(columns) + len(columns) - 1 - n
            code = code.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), place))
    return code


def morton_rewrite(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    fmt: str = "parquet",
    num_partitions: int | None = None,
    bits: int = MORTON_BITS,
) -> DataFrame:
    """Rewrite a table so that each file holds a narrow range of every column.

    Readers that filter on any one of the columns skip most files, where ``clustered_rewrite``
    serves the leading key alone. Rows of one range of all columns lie in one file unless
    they differ in the columns themselves; NULLs go with the least values. The input is read
    three times, for quantiles, ranges and rows, so give a stored table.
    """
    code = "__morton"
    coded = df.withColumn(code, morton_code(df, columns, bits))
    keys = [code, *columns]
    ranged = coded.repartitionByRange(num_partitions, *keys) if num_partitions else coded.repartitionByRange(*keys)
    return write_path(ranged.sortWithinPartitions(*keys).drop(code), path, fmt=fmt)
