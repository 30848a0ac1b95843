"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(order: Column | str) -> Column:
    return F.desc_nulls_last(order) if isinstance(order, str) else order


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[Column | str]
) -> DataFrame:
    """One row per key: the first by ``newest``, descending with NULLs last.

    Name enough columns to make the order total, otherwise any of the tied rows
    may be kept. The rank filter is applied before the shuffle as well, so each
    input task passes on one row per key and a hot key costs no more than others.
    """
    rank = "__rank"
    order = Window.partitionBy(*keys).orderBy(*[_newest_first(c) for c in newest])
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)
