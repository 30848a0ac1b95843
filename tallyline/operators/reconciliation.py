"""Comparison of a source table with the target built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.measures import count_where, percent
from tallyline.operators.digests import differing_keys
from tallyline.operators.quality import FAILED, PASSED


def populated(column: str, placeholder: str = "UNKNOWN") -> Column:
    """True where the column holds a value other than NULL and the placeholder."""
    return F.col(column).isNotNull() & (F.col(column) != placeholder)


def reconcile(
    source: DataFrame, target: DataFrame, key: str, filled: Column, check: str = "region_population"
) -> DataFrame:
    """Rows (check, source_value, target_value, match) and the overall status.

    Record counts, keys missing in the target, keys extra in the target and the
    share of filled target rows. Both sides are read once: they are counted per
    key, with a combine before the shuffle, and the counts are added up.
    """
    sides = source.select(
        F.col(key), F.lit(1).alias("s"), F.lit(0).alias("t"), F.lit(0).alias("f")
    ).unionByName(
        target.select(
            F.col(key),
            F.lit(0).alias("s"),
            F.lit(1).alias("t"),
            F.when(filled, 1).otherwise(0).alias("f"),
        )
    )
    per_key = sides.groupBy(key).agg(
        F.sum("s").alias("s"), F.sum("t").alias("t"), F.sum("f").alias("f")
    )
    total = per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("filled_rows"),
        count_where(F.col("t") == 0).alias("missing"),
        count_where(F.col("s") == 0).alias("extra"),
    )
    return _report(total, check)


def reconcile_by_digest(
    source: DataFrame,
    target: DataFrame,
    key: str,
    filled: Column,
    check: str = "region_population",
    bucket: str | None = None,
) -> DataFrame:
    """The rows of ``reconcile`` for tables too large to count key by key.

    Rows are counted, and digests of key buckets compared, where they are read. Keys are
    shuffled only in buckets that differ; with ``bucket``, the partition column by key that
    both tables share, only those partitions are read again.
    """
    differing = differing_keys(source, target, key, bucket=bucket)
    keys = differing.agg(
        count_where(F.col("right_rows") == 0).alias("missing"), count_where(F.col("left_rows") == 0).alias("extra")
    )
    rows = source.agg(F.count("*").alias("source_rows"))
    kept = target.agg(F.count("*").alias("target_rows"), count_where(filled).alias("filled_rows"))
    scalars = [
        side.select(c).scalar().alias(c)
        for side, names in ((rows, ["source_rows"]), (kept, ["target_rows", "filled_rows"]), (keys, ["missing", "extra"]))
        for c in names
    ]
    return _report(source.sparkSession.range(1).select(*scalars), check)


def _report(total: DataFrame, check: str) -> DataFrame:
    equal = F.col("source_rows") == F.col("target_rows")
    no_missing, no_extra = F.col("missing") == 0, F.col("extra") == 0
    status = F.when(equal & no_missing & no_extra, F.lit(PASSED)).otherwise(F.lit(FAILED))

    def row(name: str, source_value: Column, target_value: Column, match: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            source_value.cast("double").alias("source_value"),
            target_value.cast("double").alias("target_value"),
            match.alias("match"),
            status.alias("overall_status"),
        )

    rows = [
        row("record_count", F.col("source_rows"), F.col("target_rows"), equal),
        row("missing_in_target", F.lit(0), F.col("missing"), no_missing),
        row("extra_in_target", F.lit(0), F.col("extra"), no_extra),
        row(
            check,
            F.col("filled_rows"),
            percent("filled_rows", "target_rows"),
            F.lit(None).cast("boolean"),
        ),
    ]
    return total.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
