"""Steps kept in the folder that all executors share, so that a lost executor costs no recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.sources.keyed import remove
from tallyline.sources.workspace import new_path


# Spark deletes the shuffle files of a statement at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write the rows as Parquet below ``spark.checkpoint.dir`` and read them back.

    What was shuffled for them is deleted at once, as the rows are read from their files from then on.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_path = path
    return back


def free(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for these frames, once nothing that reads them is still to come."""
    for df in frames:
        remove(df.sparkSession, df.stored_path)
