"""Unions, distinct keys and duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.windows import latest_per_key


def union_all(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name; duplicates stay."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=fill_missing), frames
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def drop_duplicates(
    df: DataFrame, keys: Sequence[str], newest: Sequence[Column | str]
) -> DataFrame:
    """One row per key with a defined survivor."""
    return latest_per_key(df, keys, newest)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)
    )


def consolidate(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of several sources in one frame, tagged with where they come from."""
    tagged = [df.withColumn("source_table", F.lit(name)) for name, df in sources.items()]
    return union_all(tagged, fill_missing=True)
