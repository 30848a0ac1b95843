"""Amendment events from a landing folder, file by file as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyline import schemas
from tallyline.plans.amendments import assess, extract_event_meta
from tallyline.sources.readers import parse_landing, scan_path


def landing_stream(
    spark: SparkSession, folder: str, null_value: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Landing files as a stream, cut as ``parse_landing`` does it."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return parse_landing(lines, schemas.schema("landing_event"), null_value)


def start(
    landing: DataFrame,
    template: DataFrame,
    folder: str,
    strict: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Assess what has arrived since the last run, then stop.

    A malformed line is a schema reject that keeps its text. The file sink logs which files belong to a finished micro-batch, so a batch
    that is run again after a failure leaves its rows exactly once.
    """
    rows = assess(extract_event_meta(landing), template, strict)
    return (
        rows.writeStream.format(fmt)
        .partitionBy("outcome")
        .option("path", f"{folder}/assessed")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def assessed(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """All assessed events so far."""
    return scan_path(spark, f"{folder}/assessed", fmt)
