"""Table and file scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Fixed value: statuses an incremental extract takes.
EXTRACT_STATUSES = ("ACTIVE", "PENDING")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Database table.

    Without a split the database is read by a single task. ``column``, ``bounds``
    and ``num_partitions`` read ranges of a numeric or date column in parallel;
    ``predicates`` gives one task per condition and suits skewed columns. The
    bounds only place the splits, no row outside them is lost.
    """
    options: dict = {}
    if predicates is not None:
        options["predicates"] = list(predicates)
    elif column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partition column needs bounds and num_partitions")
        low, high = bounds
        options.update(
            column=column, lowerBound=low, upperBound=high, numPartitions=num_partitions
        )
    return spark.read.jdbc(url=url, table=table, properties=dict(properties), **options)


def scan_path(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Table stored under a path; ``merge_schema`` unites files of several versions."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


# How line breaks are written in a field of one line, the escape sign itself first.
LINE_ESCAPES = {"\\": "\\\\", "\n": "\\n", "\r": "\\r"}


def unescaped(value: Column) -> Column:
    """Text whose line breaks were written as escapes."""
    parts = F.split(value, r"\\\\", -1)
    plain = F.transform(
        parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    )
    return F.array_join(plain, "\\")


def scan_pipe_csv(
    spark: SparkSession, path: str, schema: StructType, null_value: str | None = None
) -> DataFrame:
    """Pipe-delimited file without header, as ``write_pipe_csv`` writes it, with a declared schema.

    Fields with delimiters or quotes are quoted, quotes inside doubled, and line breaks are
    escapes, so every row is one line. ``null_value`` is the text that stands for NULL. With
    one given, an empty field reads as empty text; without, Spark's rule holds and it reads as
    NULL. A line that does not fit the schema fails the read.
    """
    reader = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("header", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value).option("emptyValue", "")
    rows = reader.csv(path)
    texts = {f.name: unescaped(F.col(f.name)) for f in schema.fields if isinstance(f.dataType, StringType)}
    return rows.withColumns(texts) if texts else rows


def parse_landing(
    lines: DataFrame, schema: StructType, null_value: str | None = None
) -> DataFrame:
    """Landing lines (value) as rows of the schema, and ``malformed``.

    A line is cut at its first delimiters only: the last field is all that is left, delimiters,
    quotes and backslashes included. A line with too few fields, or whose field does not fit its
    type, is malformed: it has its text whole in the last field and NULL in the others.
    """
    fields = schema.fields
    parts = F.split("value", r"\|", len(fields))
    null = F.lit("" if null_value is None else null_value)
    texts = [F.nullif(F.get(parts, i), null) for i in range(len(fields))]
    typed = [t.try_cast(f.dataType) for t, f in zip(texts, fields, strict=True)]
    bad = F.size(parts) < len(fields)
    for text, value in zip(texts, typed, strict=True):
        bad = bad | (text.isNotNull() & value.isNull())
    rows = lines.select("value", bad.alias("malformed"), *[v.alias(f.name) for v, f in zip(typed, fields, strict=True)])
    *head, last = [f.name for f in fields]
    return rows.select(
        *[F.when(~F.col("malformed"), F.col(c)).alias(c) for c in head],
        F.when(F.col("malformed"), F.col("value")).otherwise(F.col(last)).alias(last),
        "malformed",
    )


def scan_landing(
    spark: SparkSession, path: str, schema: StructType, null_value: str | None = None
) -> DataFrame:
    """Landing files read line by line; see ``parse_landing``."""
    return parse_landing(spark.read.text(path), schema, null_value)


def scan_incremental(
    source: DataFrame,
    column: str,
    since: Column,
    columns: Sequence[str] | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Projection of the rows that lie at or after the last processed value.

    The predicate is a plain comparison, so file sources prune row groups with it.
    """
    recent = F.col(column) >= since if inclusive else F.col(column) > since
    rows = source.filter(recent)
    return rows.select(*columns) if columns else rows


def scan_incremental_tagged(
    source: DataFrame,
    column: str,
    since: Column,
    source_table: str,
    batch_id: str,
    extracted_at: Column | None = None,
    statuses: Sequence[str] = EXTRACT_STATUSES,
    order: Sequence[str] | None = None,
    max_partitions: int | None = None,
) -> DataFrame:
    """Incremental extract of wanted statuses, tagged with source, batch and time.

    ``order`` gives a total order; put a unique column last so that ties on the
    first one can be split between tasks. ``max_partitions`` merges input tasks
    and is off by default, as it bounds the parallelism of the whole scan.
    """
    rows = source.filter(F.col(column) >= since)
    if max_partitions is not None:
        rows = rows.coalesce(max_partitions)
    rows = tag_extract(rows, source_table, batch_id, extracted_at, statuses)
    return rows.orderBy(*order) if order else rows


def tag_extract(
    rows: DataFrame,
    source_table: str,
    batch_id: str,
    extracted_at: Column | None = None,
    statuses: Sequence[str] = EXTRACT_STATUSES,
) -> DataFrame:
    """Rows of the wanted statuses with source, batch and time of their extraction."""
    return rows.filter(F.col("status").isin(*statuses)).withColumns(
        {
            "extraction_timestamp": F.current_timestamp() if extracted_at is None else extracted_at,
            "source_table": F.lit(source_table),
            "extraction_batch_id": F.lit(batch_id),
        }
    )


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or an empty frame of the schema where it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)
