"""K-means over numeric columns: layout by cluster, and far-off rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallyline.operators.layout import partition_by_key
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path

ROUNDS = 20
# How far centres may move in the last round.
TOLERANCE = 1e-4
MILLION = 1_000_000
# Type in whose text form features are hashed.
EXACT = "decimal(38,9)"
Centers = list[list[float]]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def _squares(columns: Sequence[str], center: Sequence[float]) -> Column:
    parts = [(_value(c) - F.lit(x)) * (_value(c) - F.lit(x)) for c, x in zip(columns, center, strict=True)]
    return sum(parts[1:], parts[0])


def first_centers(df: DataFrame, columns: Sequence[str], k: int, seed: int) -> Centers:
    """k rows to start from, far from one another, the same for every layout of the table.

    The first one has the least keyed hash of its features. Each round draws the next one with a
    chance in proportion to its squared distance from the nearest so far: the row with the
    least -ln(u) / distance, where u is made of the keyed hash. A round is one pass with a
    minimum, and brings one row to the driver. Rows with equal features count as one in the
    draw; with fewer than k different rows there are fewer centres.
    """
    features = [_value(c).alias(c) for c in columns]
    texts = [F.col(c).cast(EXACT).cast("string") for c in columns]
    rows = df.select(*features)
    centers: Centers = []
    for turn in range(k):
        digest = F.md5(F.concat_ws("|", F.lit(f"{seed}:{turn}"), *texts))
        u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
        if centers:
            nearest = F.least(*[_squares(columns, c) for c in centers]) if len(centers) > 1 else _squares(columns, centers[0])
            drawn = rows.withColumn("__d", nearest).filter("__d > 0").withColumn("__key", -F.log(u) / F.col("__d"))
        else:
            drawn = rows.withColumn("__key", u)
        found = drawn.agg(F.min(F.struct("__key", *columns)).alias("row")).first()["row"]
        if found is None:
            break
        centers.append([found[c] for c in columns])
    return centers


def fit_centers(df: DataFrame, columns: Sequence[str], k: int, seed: int, rounds: int = ROUNDS) -> Centers:
    """Centres of the clusters, the same for every layout of the table; only the features are read.

    Features are stored once and rounds read them. Sums are exact, of whole parts and of
    millionths, so they do not depend on the order of rows; a sum beyond 2^63 fails. Only the
    k sums of a round reach the driver. A cluster that loses all its rows keeps its centre.
    """
    inputs = df.select(*[_value(c).alias(c) for c in columns])
    stored = write_path(inputs, new_path(df.sparkSession, "features"))
    centers = first_centers(stored, columns, k, seed)
    for _ in range(rounds if centers else 0):
        sums = with_nearest(stored, columns, centers, "__number").groupBy("__number").agg(
            F.count("*").alias("__n"),
            *[F.sum(F.floor(c)).alias(f"{c}__whole") for c in columns],
            *[F.sum(F.floor((F.col(c) - F.floor(c)) * MILLION + 0.5)).alias(f"{c}__rest") for c in columns],
        )
        moved = list(centers)
        for row in sums.collect():
            totals = [MILLION * row[f"{c}__whole"] + row[f"{c}__rest"] for c in columns]
            moved[row["__number"]] = [total / (MILLION * row["__n"]) for total in totals]
        steps = [math.dist(a, b) for a, b in zip(centers, moved, strict=True)]
        centers = moved
        if max(steps) <= TOLERANCE:
            break
    return centers


def with_nearest(df: DataFrame, columns: Sequence[str], centers: Centers, name: str) -> DataFrame:
    """Rows with the number of the nearest centre, the first of several."""
    if not centers:
        return df.withColumn(name, F.lit(None).cast("int"))
    squares = {f"__square_{k}": _squares(columns, c) for k, c in enumerate(centers)}
    least = F.least(*squares) if len(squares) > 1 else F.col("__square_0")
    number = F.coalesce(*[F.when(F.col(s) == least, F.lit(k)) for k, s in enumerate(squares)])
    return df.withColumns(squares).withColumn(name, number).drop(*squares)


def distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    return F.sqrt(_squares(columns, center))


def distance_to_own(columns: Sequence[str], centers: Centers, name: str = "prediction") -> Column:
    own = [F.when(F.col(name) == i, distance(columns, c)) for i, c in enumerate(centers)]
    return F.coalesce(*own) if own else F.lit(None).cast("double")


def clustered(
    df: DataFrame, columns: Sequence[str], k: int = 10, seed: int = 1, name: str = "prediction"
) -> tuple[DataFrame, Centers]:
    """Rows with the number of the nearest centre, the first of several, and the centres."""
    centers = fit_centers(df, columns, k, seed)
    return with_nearest(df, columns, centers, name), centers


def by_cluster(rows: DataFrame, name: str = "prediction") -> DataFrame:
    """Rows laid out by cluster; a large cluster is split."""
    return partition_by_key(rows, [name])


def kmeans_partitioning(
    df: DataFrame, columns: Sequence[str], k: int = 10, seed: int = 1, name: str = "prediction"
) -> DataFrame:
    """Rows with their cluster, laid out by it."""
    return by_cluster(clustered(df, columns, k, seed, name)[0], name)


def scored(
    df: DataFrame,
    columns: Sequence[str],
    k: int = 3,
    seed: int = 42,
    quantile: float = 0.99,
    accuracy: int = 10_000,
) -> DataFrame:
    """Every row with cluster, distance, the limit of its cluster, and whether it is beyond that.

    Rows are scored once, into the shared folder; the limits and the result read that.
    """
    if not all(isinstance(df.schema[c].dataType, NumericType) for c in columns):
        raise ValueError("K-means needs numeric columns")
    rows, centers = clustered(df, columns, k, seed, "cluster")
    measured = rows.withColumn("distance", distance_to_own(columns, centers, "cluster"))
    measured = write_path(measured, new_path(df.sparkSession, "scored"))
    limits = measured.groupBy("cluster").agg(
        F.percentile_approx("distance", F.lit(quantile), F.lit(accuracy)).alias("limit")
    )
    # the limits are k rows at most, whatever the size of the input
    return measured.join(F.broadcast(limits), "cluster").select(
        *df.columns, "cluster", "distance", "limit", (F.col("distance") > F.col("limit")).alias("is_anomaly")
    )


def kmeans_anomalies(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    k: int = 3,
    seed: int = 42,
    quantile: float = 0.99,
    accuracy: int = 10_000,
) -> DataFrame:
    """Rows farther from the centre of their cluster than a quantile of its rows.

    With fewer than two numeric columns the result is empty.
    """
    used = list(columns) if columns is not None else numeric_columns(df)
    if not all(isinstance(df.schema[c].dataType, NumericType) for c in used):
        raise ValueError("K-means needs numeric columns")
    if len(used) < 2:
        return df.filter(F.lit(False)).withColumns(
            {"cluster": F.lit(None).cast("int"), "distance": F.lit(None).cast("double")}
        )
    rows = scored(df, used, k, seed, quantile, accuracy)
    return rows.filter("is_anomaly").select(*df.columns, "cluster", "distance")
