"""Table and file sinks. Every sink can be run again with the same result.

The storage format is a parameter. Where a lake format has its own statement for
a task it is used; the parquet way beside it needs nothing but a folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline.sources.readers import LINE_ESCAPES, scan_path

# Characters that Spark escapes in the names of partition folders, and the
# folder of NULL.
ESCAPED_IN_FOLDERS = "\"#%'*/:=?\\{[]^\x7f"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _writer(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str] | None = None):
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    return writer.partitionBy(*partition_by) if partition_by else writer


def even_files(df: DataFrame, *columns: str) -> DataFrame:
    """Group rows by the columns before a write.

    Adaptive execution splits a hot value over several tasks and merges small
    ones, so one partition value with a third of the rows is no straggler.
    """
    return df.hint("rebalance", *columns)


def overwrite_table(
    df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None
) -> DataFrame:
    """Replace a whole catalog table and return it. ``path`` makes it external."""
    writer = _writer(df, "overwrite", fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_path(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    even: bool = False,
    codec: str | None = None,
) -> DataFrame:
    """Write under a path and return the stored table.

    ``even`` groups rows by the partition columns first. It costs a shuffle and
    pays when every task holds many partition values; few values need none. ``codec`` is
    the compression of the files, the session's by default.
    """
    if partition_by and even:
        df = even_files(df, *partition_by)
    writer = _writer(without_empty(df, partition_by or ()), mode, fmt, partition_by)
    (writer if codec is None else writer.option("compression", codec)).save(path)
    return read_back(df, path, fmt, whole=mode != "append")


def without_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows, failing on empty text in a partition column: it would be read back as NULL."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    message = F.lit("empty text cannot be a partition value")
    return df.withColumns({c: F.when(F.col(c) == "", F.raise_error(message)).otherwise(F.col(c)) for c in texts})


def read_back(df: DataFrame, path: str, fmt: str = "parquet", whole: bool = True) -> DataFrame:
    """The stored table with the declared types of ``df``, so that '007' stays text.

    Without ``whole`` the table may hold further columns, which are read as they are.
    """
    spark = df.sparkSession
    if fmt == "delta":
        return scan_path(spark, path, fmt)
    fields = {f.name: StructField(f.name, f.dataType, True) for f in df.schema.fields}
    if not whole:
        found = scan_path(spark, path, fmt).schema.fields
        fields |= {f.name: f for f in found if f.name not in fields}
    return scan_path(spark, path, fmt, StructType(list(fields.values())))


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Add rows to a stored table."""
    return write_path(df, path, mode="append", fmt=fmt)


def write_evolving(
    df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet"
) -> DataFrame:
    """Write rows that may have new columns and return the table with all of them.

    Older rows read NULL in the new columns. For parquet the schemas are united
    on reading, which looks at every file; other sinks do without that.
    """
    write_path(df, path, mode, fmt)
    return scan_path(df.sparkSession, path, fmt, merge_schema=fmt == "parquet")


def write_verified(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
) -> int:
    """Write and return the number of rows found in the stored table.

    The count comes from the stored files (their footers, for parquet) and not
    from metrics of the write, which count a task twice when it is run again.
    """
    return write_path(df, path, mode, fmt, partition_by).count()


def partition_folder(path: str, column: str, value: str | dt.date | None) -> str:
    """The folder that Spark gives a partition value."""

    def name(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_FOLDERS or c < " " else c for c in text)

    folder = NULL_FOLDER if value is None or value == "" else name(str(value))
    return f"{path.rstrip('/')}/{name(column)}={folder}"


def replace_partition(
    df: DataFrame, path: str, column: str, value: str | dt.date | None, fmt: str = "parquet"
) -> DataFrame:
    """Replace the rows of one partition value and leave all others as they are.

    Rows of ``df`` with another value are not written. Spark names the folder and
    puts it in place once all rows are written. Dynamic overwrite would keep the old
    rows of an empty day, so the folder of such a day is overwritten by itself.
    """
    day = without_empty(df.filter(F.col(column).eqNullSafe(F.lit(value))), [column])
    if fmt == "delta":
        condition = f"{column} IS NULL" if value is None else f"{column} = '{value}'"
        day.write.format(fmt).mode("overwrite").option("replaceWhere", condition).save(path)
    else:
        seen = Observation()
        (
            day.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .save(path)
        )
        if not seen.get.get("rows"):
            folder = partition_folder(path, column, value)
            day.drop(column).limit(0).write.format(fmt).mode("overwrite").save(folder)
    return read_back(df, path, fmt, whole=False)


def replace_partitions(
    df: DataFrame, path: str, column: str, values: Sequence[str | dt.date], fmt: str = "parquet"
) -> DataFrame:
    """Replace the rows of several partition values in one write and leave all others as they are.

    Rows of ``df`` with another value are not written. A value without rows is emptied: dynamic
    overwrite would keep what it had, so its folder is overwritten by itself.
    """
    if not values:
        return read_back(df, path, fmt, whole=False)
    rows = without_empty(df.filter(F.col(column).isin(*values)), [column])
    if fmt == "delta":
        named = ", ".join(f"'{v}'" for v in values)
        rows.write.format(fmt).mode("overwrite").option("replaceWhere", f"{column} IN ({named})").save(path)
        return read_back(df, path, fmt, whole=False)
    seen = Observation()
    counts = [F.count(F.when(F.col(column) == F.lit(v), 1)).alias(f"n{k}") for k, v in enumerate(values)]
    (
        rows.observe(seen, *counts)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .save(path)
    )
    for k, value in enumerate(values):
        if not seen.get.get(f"n{k}"):
            rows.drop(column).limit(0).write.format(fmt).mode("overwrite").save(partition_folder(path, column, value))
    return read_back(df, path, fmt, whole=False)


def publish(staged: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Put a stored and checked table in place of the one under a path."""
    return write_path(staged, path, fmt=fmt)


def write_pipe_csv(
    df: DataFrame, path: str, mode: str = "overwrite", null_value: str | None = None
) -> None:
    """Pipe-delimited text without header, one line per row.

    Fields with delimiters or quotes are quoted, with quotes inside doubled. Line breaks
    are written as the escapes of ``LINE_ESCAPES``, which ``scan_pipe_csv`` undoes, as a
    field of several lines would make files unsplittable. ``null_value`` is written for
    NULL and keeps it apart from empty text, which is written as a pair of quotes.
    """
    texts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            value = F.col(field.name)
            for sign, escape in LINE_ESCAPES.items():
                value = F.replace(value, F.lit(sign), F.lit(escape))
            texts[field.name] = value
    writer = (
        (df.withColumns(texts) if texts else df)
        .write.mode(mode)
        .option("quote", '"')
        .option("escape", '"')
        .option("sep", "|")
        .option("header", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def write_ordered(
    df: DataFrame, columns: Sequence[str], path: str, mode: str = "overwrite", fmt: str = "parquet"
) -> DataFrame:
    """Write exactly these columns in this order."""
    return write_path(df.select(*columns), path, mode, fmt)
