"""Joins against dimensions and lookups, and key comparisons.

No join carries a broadcast hint. Spark broadcasts a side whose size it knows to
be below its threshold; any other join is sort-merge, where adaptive execution
splits a partition that one hot key has blown up. Keys that are only compared or
counted are first reduced to one row each, which takes hot keys out of the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.windows import latest_per_key


def unmatched_rows(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of the fact side without a partner and the rows they stand for.

    A NULL key has no partner.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("unmatched_rows"))
    return per_key.join(dimension.select(key).distinct(), key, "left_anti")


def unmatched_count(
    fact: DataFrame, dimension: DataFrame, key: str, name: str = "unmatched_rows"
) -> DataFrame:
    """One row: how many fact rows have no partner."""
    rows = unmatched_rows(fact, dimension, key)
    return rows.agg(F.coalesce(F.sum("unmatched_rows"), F.lit(0)).alias(name))


def key_presence(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """One row per key with its number of rows on either side.

    One aggregation over both sides does the work of two anti-joins, and counts
    are combined before the shuffle.
    """
    sides = source.select(
        F.col(key), F.lit(1).alias("in_source"), F.lit(0).alias("in_target")
    ).unionByName(
        target.select(F.col(key), F.lit(0).alias("in_source"), F.lit(1).alias("in_target"))
    )
    return sides.groupBy(key).agg(
        F.sum("in_source").alias("source_rows"), F.sum("in_target").alias("target_rows")
    )


def key_reconcile(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that stand on one side only, with the finding."""
    found = key_presence(source, target, key)
    finding = F.when(F.col("target_rows") == 0, F.lit("missing_in_target")).when(
        F.col("source_rows") == 0, F.lit("extra_in_target")
    )
    return found.select(key, finding.alias("finding")).filter(F.col("finding").isNotNull())


def referential_integrity(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """One row: child rows and distinct child keys that have no parent.

    A NULL child key refers to nothing and is not counted.
    """
    per_key = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count("*").alias("rows")
    )
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return per_key.join(parents, child_key, "left_anti").agg(
        F.count("*").alias("orphan_keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
    )


def safe_dimension_join(
    base: DataFrame, dimension: DataFrame, key: str, newest: Sequence[Column | str]
) -> DataFrame:
    """Left join to the latest dimension row per key; an empty base is an error.

    Give a stored base: the test for emptiness then reads its first row only.
    """
    if base.isEmpty():
        raise ValueError("the base of the join has no rows")
    return base.join(latest_per_key(dimension, [key], newest), key, "left")


def single_row_lookup(lookup: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The lookup with one row per key; a key that occurs twice fails the job."""
    value = F.struct(*columns)
    one = F.when(F.count("*") == 1, F.first(value)).otherwise(
        F.raise_error(
            F.concat(F.lit("lookup key occurs more than once: "), F.first(key).cast("string"))
        )
    )
    return lookup.groupBy(key).agg(one.alias("__found")).select(key, "__found.*")


def scalar_backfill(
    df: DataFrame, lookup: DataFrame, key: str, defaults: Mapping[str, object]
) -> DataFrame:
    """Fill NULL columns from a lookup by key, then from the default.

    ``defaults`` maps each column to fill to the value used where the lookup has
    no row or a NULL.
    """
    values = single_row_lookup(lookup, key, list(defaults))
    renamed = values.select(key, *[F.col(c).alias(f"__{c}") for c in defaults])
    joined = df.join(renamed, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__{c}"), F.lit(defaults[c])).alias(c)
            if c in defaults
            else F.col(c)
            for c in df.columns
        ]
    )
