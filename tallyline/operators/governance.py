"""Source-to-target mappings, masking, retention, lineage and schema changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.functions.cleansing import (
    RETENTION_MONTHS,
    STATUS_TWO_WAY,
    STATUS_TWO_WAY_DEFAULT,
    bounded_round,
    map_status,
    or_unknown,
    processing_timestamp,
    retention_date,
    upper_trim,
)
from tallyline.functions.protection import (
    MaskKey,
    change_hash,
    checksum_md5,
    encrypt,
    mask_hash,
    mask_hmac,
    mask_partial,
    mask_prefix4,
)
from tallyline.operators.joins import scalar_backfill, single_row_lookup
from tallyline.operators.windows import latest_per_key

# Constants of the mapped rows.
SOURCE_SYSTEM = "NEW_SOURCE"
DATA_CLASS = "INTERNAL"
OPEN_END = "9999-12-31 23:59:59"
ANONYMIZED = "ANONYMIZED"

# Columns of a source record whose change makes a new version.
TRACKED = ("id", "column1", "column2", "column3", "status")

# Names of the masking rules.
MASKS = {"HASH": mask_hash, "PARTIAL_MASK": mask_partial, "PREFIX_MASK": mask_prefix4}


# -- mappings -----------------------------------------------------------------------


def map_source(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Eight target columns of a source record."""
    return df.select(
        F.col("id").alias("new_source_id"),
        F.upper("column1").alias("new_source_column1"),
        F.trim("column2").alias("new_source_column2"),
        F.round("column3", 2).alias("new_source_column3"),
        F.col("created_date").alias("source_created_date"),
        map_status("status", STATUS_TWO_WAY, STATUS_TWO_WAY_DEFAULT).alias("record_status"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        processing_timestamp(now).alias("load_timestamp"),
    )


def map_source_secure(
    df: DataFrame,
    masks: Mapping[str, str] | None = None,
    now: Column | None = None,
    as_of: Column | None = None,
    change_key: str | None = None,
    mask_key: MaskKey | None = None,
) -> DataFrame:
    """Masked record with history, checksum, batch and retention columns, fifteen in all.

    ``source_checksum`` covers the masked values as the target holds them. With a secret
    ``change_key`` a ``change_hash`` follows, a keyed hash of all tracked columns before
    masking, which tells one version of a history from another and nothing to those without
    the key. The input carries ``data_quality_score`` and ``extraction_batch_id``.
    """
    if change_key is not None:
        df = df.withColumn("__change", change_hash(TRACKED, change_key))
    masked = mask_columns(df, masks or {}, mask_key)
    start_type = masked.schema["created_date"].dataType
    checked = ["id", "column1", "column2", "column3"]
    return masked.select(
        F.col("id").alias("business_key"),
        upper_trim("column1").alias("new_source_column1"),
        or_unknown(F.trim("column2")).alias("new_source_column2"),
        bounded_round("column3").alias("new_source_column3"),
        F.col("created_date").alias("effective_start_date"),
        map_status("status").alias("record_status"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        processing_timestamp(now).alias("created_timestamp"),
        F.lit(True).alias("is_current"),
        F.lit(OPEN_END).cast(start_type).alias("effective_end_date"),
        "data_quality_score",
        checksum_md5(checked).alias("source_checksum"),
        F.col("extraction_batch_id").alias("batch_id"),
        F.lit(DATA_CLASS).alias("data_classification"),
        retention_date(as_of).alias("retention_date"),
        *([] if change_key is None else [F.col("__change").alias("change_hash")]),
    )


# -- protection and retention --------------------------------------------------------


def mask_columns(df: DataFrame, masks: Mapping[str, str], key: MaskKey | None = None) -> DataFrame:
    """Apply a masking rule per column; columns the frame lacks are passed over.

    The rule ``HMAC`` needs a key. ``HASH`` is without one, so short values can be found by
    trying all of them.
    """
    rules = MASKS if key is None else {**MASKS, "HMAC": lambda value: mask_hmac(value, key)}
    if "HMAC" in masks.values() and key is None:
        raise ValueError("the rule HMAC needs a key")
    return df.withColumns(
        {c: rules[rule](F.col(c)) for c, rule in masks.items() if c in df.columns}
    )


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    return df.withColumns({c: encrypt(c, key) for c in columns if c in df.columns})


def anonymize_expired(
    df: DataFrame,
    as_of: Column | None = None,
    column: str = "new_source_column1",
    expires: str = "retention_date",
) -> DataFrame:
    """Overwrite the value of expired rows; a row without expiry date keeps its value."""
    today = F.current_date() if as_of is None else as_of
    hidden = F.when(F.col(expires) < today, F.lit(ANONYMIZED)).otherwise(F.col(column))
    return df.withColumn(column, hidden)


def without_expired(
    df: DataFrame, date: str, as_of: Column | None = None, months: int = RETENTION_MONTHS
) -> DataFrame:
    """Rows that remain after deleting those older than the retention time.

    Rows without a date remain. Store the result under a new path.
    """
    today = F.current_date() if as_of is None else as_of
    expired = F.coalesce(F.col(date) < F.add_months(today, -months), F.lit(False))
    return df.filter(~expired)


# -- incremental load -----------------------------------------------------------------


def changed_since(
    df: DataFrame,
    since: Column,
    columns: Sequence[str] = ("created_date", "updated_date"),
    inclusive: bool = False,
) -> DataFrame:
    """Rows of which any of the dates lies after the bound."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | (F.col(name) >= since if inclusive else F.col(name) > since)
    return df.filter(hit)


def new_watermark(
    batch: DataFrame, table: str, columns: str | Sequence[str], now: Column | None = None
) -> DataFrame:
    """One control row: the highest value of the batch in any of the columns; NULL of no rows."""
    names = [columns] if isinstance(columns, str) else list(columns)
    newest = F.greatest(*[F.max(c) for c in names]) if len(names) > 1 else F.max(names[0])
    return batch.agg(newest.alias("last_processed_date")).select(
        F.lit(table).alias("table_name"),
        "last_processed_date",
        processing_timestamp(now).alias("updated_timestamp"),
    )


def upsert_watermark(control: DataFrame, update: DataFrame) -> DataFrame:
    """Control table with the greatest processed value of each table.

    An empty batch, whose value is NULL, and a batch that comes late change nothing.
    """
    known = control.unionByName(update).filter(F.col("last_processed_date").isNotNull())
    return latest_per_key(known, ["table_name"], ["last_processed_date", "updated_timestamp"])


# -- lineage ---------------------------------------------------------------------------


def with_lineage(
    df: DataFrame, source_system: str, transformation: str, now: Column | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "source_system": F.lit(source_system),
            "transformation_applied": F.lit(transformation),
            "processing_timestamp": processing_timestamp(now),
        }
    )


def lineage_rows(
    target: DataFrame,
    record_id: str,
    source_table: str,
    target_table: str,
    transformation: str,
    batch_id: str,
    score: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One lineage row per record.

    The id is a hash of what the row stands for. A running number would need all
    rows in one place, and would change when a lost task is run again.
    """
    parts = [F.lit(target_table), F.col(record_id), F.lit(batch_id)]
    quality = F.lit(None) if score is None else score
    return target.select(
        checksum_md5(parts).alias("lineage_id"),
        F.lit(source_table).alias("source_table"),
        F.lit(target_table).alias("target_table"),
        F.col(record_id).cast("bigint").alias("record_id"),
        F.lit(transformation).alias("transformation_applied"),
        processing_timestamp(now).alias("processed_timestamp"),
        F.lit(batch_id).alias("batch_id"),
        quality.cast("decimal(5,2)").alias("data_quality_score"),
    )


# -- backfill and schema changes ----------------------------------------------------------


def backfill_category(summary: DataFrame, metadata: DataFrame) -> DataFrame:
    """Fill NULL tile categories from the metadata, else UNKNOWN."""
    return scalar_backfill(summary, metadata, "tile_id", {"tile_category": "UNKNOWN"})


def backfill_branch_details(report: DataFrame, details: DataFrame) -> DataFrame:
    """Where REGION or LAST_AUDIT_DATE is NULL, take both from the details.

    A value that was there is replaced as well when its neighbour is NULL.
    """
    defaults = {"REGION": "UNKNOWN", "LAST_AUDIT_DATE": "NOT_AVAILABLE"}
    texts = details.select("BRANCH_ID", *[F.col(c).cast("string") for c in defaults])
    found = single_row_lookup(texts, "BRANCH_ID", list(defaults)).select(
        "BRANCH_ID", *[F.col(c).alias(f"__{c}") for c in defaults]
    )
    incomplete = F.col("REGION").isNull() | F.col("LAST_AUDIT_DATE").isNull()
    return report.join(found, "BRANCH_ID", "left").select(
        *[
            F.when(incomplete, F.coalesce(F.col(f"__{c}"), F.lit(defaults[c])))
            .otherwise(F.col(c))
            .alias(c)
            if c in defaults
            else F.col(c)
            for c in report.columns
        ]
    )


def evolve_schema(
    df: DataFrame, target: StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Columns of the target in its order; new ones hold their default or NULL.

    A column that the target lacks is an error: evolving adds columns and drops none.
    """
    if extra := [c for c in df.columns if c not in target.fieldNames()]:
        raise ValueError(f"the target schema has no column {', '.join(extra)}")
    values = defaults or {}
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(values.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.fields
        ]
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Take added columns back; store the result under a new path."""
    return df.drop(*columns)
