"""Comparing the keys of two large tables by digests, so that equal parts are never joined.

Keys are dealt into buckets by hash. A bucket's digest is its number of rows, the exclusive or
of one hash of the keys and the sums of another one; rows of a bucket are added up where they
are read, so a pass moves one row per bucket and task. Buckets whose digests agree hold the same
keys equally often, but for a chance of 2^-64 or less for each. Two levels of buckets keep
what is compared key by key small: only fine buckets that differ, within coarse ones that do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = (256, 256)
_KEY, _BUCKET = "__key", "__bucket"
_LOW = (1 << 32) - 1


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(_KEY), F.lit(buckets)).cast("int")


def _digests(keys: DataFrame) -> DataFrame:
    """(bucket, digest) of rows with a bucket."""
    one, other = F.xxhash64(_KEY), F.xxhash64(_KEY, F.lit("other"))
    digest = F.struct(
        F.count("*").alias("rows"),
        F.bit_xor(one).alias("xor"),
        F.sum(other.bitwiseAND(F.lit(_LOW))).alias("low"),
        F.sum(F.shiftrightunsigned(other, 32)).alias("high"),
    )
    return keys.groupBy(_BUCKET).agg(digest.alias("digest"))


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose digests differ; at most as many as there are."""
    sides = _digests(left), _digests(right).withColumnRenamed("digest", "other")
    both = sides[0].join(sides[1], _BUCKET, "full_outer")
    return both.filter(~F.col("digest").eqNullSafe(F.col("other"))).select(_BUCKET)


def keys_of(left: DataFrame, right: DataFrame, key: str, other: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The keys of both tables under one name and of one type."""
    sides = [left.select(F.col(key).alias(_KEY)), right.select(F.col(other or key).alias(_KEY))]
    kind = sides[0].limit(0).union(sides[1].limit(0)).schema[_KEY].dataType
    return tuple(s.withColumn(_KEY, F.col(_KEY).cast(kind)) for s in sides)


def differing_keys(
    left: DataFrame,
    right: DataFrame,
    key: str,
    other: str | None = None,
    levels: tuple[int, int] = LEVELS,
    bucket: str | None = None,
) -> DataFrame:
    """(key, left_rows, right_rows) of the keys that the tables hold differently often.

    ``other`` is the key's name on the right. ``bucket`` names a column that both tables carry
    and that depends on the key only, such as the partition column of tables stored by
    buckets of it; with one, it is the coarse level, and the second and third pass read only the
    partitions that differ. NULL is a key like others. Equal tables, empty ones included, give
    no rows.
    """
    coarse, fine = levels
    spark = left.sparkSession
    sides = keys_of(left, right, key, other)
    if bucket is not None:
        tables = (left, key), (right, other or key)
        kind = sides[0].schema[_KEY].dataType
        sides = [t.select(F.col(k).cast(kind).alias(_KEY), F.col(bucket).alias(_BUCKET)) for t, k in tables]
        first = sides
    else:
        first = [s.withColumn(_BUCKET, _bucket(coarse)) for s in sides]
    found = [r[0] for r in _differing(*first).collect()]
    known = [b for b in found if b is not None]
    among = F.col(_BUCKET).isin(known) if len(known) == len(found) else F.col(_BUCKET).isin(known) | F.col(_BUCKET).isNull()
    small = [s.filter(among if found else F.lit(False)).withColumn(_BUCKET, _bucket(coarse * fine)) for s in first]
    differing = [(r[0],) for r in (_differing(*small).collect() if found else [])]
    # at most coarse * fine numbers
    wanted = F.broadcast(spark.createDataFrame(differing, f"{_BUCKET} int"))
    left_keys, right_keys = (s.join(wanted, _BUCKET, "left_semi").select(_KEY) for s in small)
    counted = left_keys.withColumns({"l": F.lit(1), "r": F.lit(0)}).unionByName(
        right_keys.withColumns({"l": F.lit(0), "r": F.lit(1)})
    )
    counted = counted.groupBy(_KEY).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return counted.filter("left_rows <> right_rows").withColumnRenamed(_KEY, key)


def only_left(left: DataFrame, right: DataFrame, key: str, other: str | None = None, **options) -> DataFrame:
    """Distinct keys of the left table that the right one lacks."""
    return differing_keys(left, right, key, other, **options).filter("right_rows = 0").select(key)
