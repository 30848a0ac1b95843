"""Run metrics, coverage, freshness and alerts as rows."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.cleansing import processing_timestamp
from tallyline.functions.measures import count_where, percent
from tallyline.operators.reconciliation import populated
from tallyline.sources.writers import write_path

# Limits of the alerts, step duration and age of an audit.
STALE_AFTER_DAYS = 90
STEP_SECONDS_LIMIT = 300.0


STEP_METRICS = (
    "step_name string, row_count bigint, partition_count int, duration_seconds double, measured_at timestamp"
)


class Limit(NamedTuple):
    """Bound of a metric; ``minimum`` says whether the metric must stay above it."""

    label: str
    bound: float
    minimum: bool = True
    unit: str = "%"


# Type and limits of the coverage alerts, and the other limits a
# run can be held against.
COVERAGE_ALERT = "DATA_COVERAGE_WARNING"
COVERAGE_LIMITS = {
    "region_coverage_percent": Limit("Region coverage", 85.0),
    "audit_date_coverage_percent": Limit("Audit date coverage", 90.0),
}
RUN_LIMITS = {
    "stale_percentage": Limit("Stale audits", 20.0, minimum=False),
    "duration_seconds": Limit("Processing time", 1800.0, minimum=False, unit=" s"),
    "quality_score_percentage": Limit("Data quality score", 95.0),
    "record_count_variance": Limit("Record count variance", 20.0, minimum=False),
    "job_failure_rate": Limit("Job failure rate", 5.0, minimum=False),
}


class StepMetrics:
    """Row counts and durations of the steps of one job, without extra jobs.

    ``watch`` counts the rows of a frame while a later action computes it. Watch
    frames that reach the write of the action without a shuffle in between: a
    task before a shuffle can run twice when an executor is lost, and its rows
    would be counted twice. The steps of an action run together, so the duration of
    each is that of the action: wrap it in ``action()``.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []
        self._seconds: float | None = None

    @contextmanager
    def action(self) -> Iterator[None]:
        """Time what is done inside, and nothing before or after it."""
        start = time.monotonic()
        yield
        self._seconds = time.monotonic() - start

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation(step)
        self._steps.append((step, seen))
        part = "__partition"
        counted = df.withColumn(part, F.spark_partition_id())
        return counted.observe(
            seen,
            F.count(F.lit(1)).alias("row_count"),
            (F.coalesce(F.max(part), F.lit(-1)) + 1).alias("partition_count"),
        ).drop(part)

    def frame(self, spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
        """One row per step, after the action has run; ``duration_seconds`` is that of the action."""
        if self._seconds is None:
            raise ValueError("no action has been timed")
        stamp = now or dt.datetime.now()
        rows = [
            (step, seen.get["row_count"], seen.get["partition_count"], self._seconds, stamp)
            for step, seen in self._steps
        ]
        return spark.createDataFrame(rows, STEP_METRICS)


class TimedSteps:
    """Steps of a job that are each stored by an action of their own, timed and counted there.

    ``store`` writes a step below ``folder`` and returns the stored rows for the next one, so the
    time of a step is that of its own work. The jobs of a step carry its tag,
    which shows in the user interface and can be cancelled by name. Rows are counted in what is
    stored, so a task that runs twice is counted once.
    """

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "parquet") -> None:
        self._spark, self._folder, self._fmt = spark, folder, fmt
        self._rows: list[tuple[str, int, int, float]] = []

    def store(self, df: DataFrame, step: str) -> DataFrame:
        context, tag = self._spark.sparkContext, f"step: {step}".replace(",", " ")
        context.addJobTag(tag)
        try:
            start = time.monotonic()
            stored = write_path(df, f"{self._folder}/step-{len(self._rows)}", fmt=self._fmt)
            seconds = time.monotonic() - start
            count = stored.count()
        finally:
            context.removeJobTag(tag)
        self._rows.append((step, count, len(stored.inputFiles()), seconds))
        return stored

    def frame(self, now: dt.datetime | None = None) -> DataFrame:
        """One row per step, its partitions being the files it wrote."""
        stamp = now or dt.datetime.now()
        return self._spark.createDataFrame([(*row, stamp) for row in self._rows], STEP_METRICS)


def throughput(metrics: DataFrame, limit: float = STEP_SECONDS_LIMIT) -> DataFrame:
    """Rows per second of each step, and whether it took too long."""
    seconds = F.col("duration_seconds")
    rate = F.when(seconds > 0, F.col("row_count") / seconds).otherwise(F.lit(0.0))
    return metrics.withColumns({"rows_per_second": rate, "is_slow": seconds > limit})


def audit_row(
    stored: DataFrame,
    operation: str,
    table: str,
    user: str,
    application: str,
    version: str,
    seconds: float | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One audit row for a stored table.

    The count is taken from what is stored, so it holds whatever the write went
    through.
    """
    return stored.agg(F.count("*").alias("record_count")).select(
        F.lit(operation).alias("operation"),
        F.lit(table).alias("table_name"),
        "record_count",
        F.lit(seconds).cast("double").alias("processing_time_seconds"),
        F.lit(user).alias("user"),
        processing_timestamp(now).alias("timestamp"),
        F.lit(application).alias("application"),
        F.lit(version).alias("version"),
    )


def coverage(report: DataFrame) -> DataFrame:
    """One row: branches, those with region and with audit date, and the shares."""
    counted = report.agg(
        F.count("*").alias("total_branches"),
        count_where(populated("REGION")).alias("branches_with_region"),
        count_where(F.col("LAST_AUDIT_DATE").isNotNull()).alias("branches_with_audit_date"),
    )
    return counted.withColumns(
        {
            "region_coverage_percent": percent("branches_with_region", "total_branches"),
            "audit_date_coverage_percent": percent("branches_with_audit_date", "total_branches"),
        }
    )


def audit_freshness(
    details: DataFrame, as_of: Column | None = None, days: int = STALE_AFTER_DAYS
) -> DataFrame:
    """One row: stale audits of all branches as a share of the active branches."""
    oldest = F.date_sub(F.current_date() if as_of is None else as_of, days)
    counted = details.agg(
        count_where(F.col("LAST_AUDIT_DATE") < oldest).alias("stale_audit_count"),
        count_where(F.col("IS_ACTIVE") == "Y").alias("total_active_branches"),
    )
    return counted.withColumn(
        "stale_percentage", percent("stale_audit_count", "total_active_branches")
    )


def alerts(
    metrics: DataFrame,
    limits: Mapping[str, Limit] = COVERAGE_LIMITS,
    kind: str = COVERAGE_ALERT,
) -> DataFrame:
    """One row per metric of a one-row frame that breaks its limit.

    Limits of metrics the frame does not have are passed over.
    """
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(name).cast("double").alias("value"),
            F.lit(limit.bound).alias("bound"),
            F.lit(kind).alias("type"),
            F.format_string(
                "%s is %.1f%s, %s threshold of %s%s",
                F.lit(limit.label),
                F.col(name).cast("double"),
                F.lit(limit.unit),
                F.lit("below" if limit.minimum else "above"),
                F.lit(str(limit.bound)),
                F.lit(limit.unit),
            ).alias("message"),
            (
                F.col(name) < limit.bound if limit.minimum else F.col(name) > limit.bound
            ).alias("broken"),
        )
        for name, limit in limits.items()
        if name in metrics.columns
    ]
    judged = metrics.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
    return judged.filter("broken").drop("broken")
