"""Incremental load of source records into a history table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators import digests, governance, history
from tallyline.operators.quality import QUALITY_THRESHOLD, quality_gate, require
from tallyline.operators.windows import latest_per_key
from tallyline.sources import keyed
from tallyline.sources.readers import EXTRACT_STATUSES, scan_path, tag_extract
from tallyline.sources.writers import replace_partition, write_path

KEY = "id"
DATES = ("created_date", "updated_date")


class Loaded(NamedTuple):
    history: DataFrame
    lineage: DataFrame
    watermark: DataFrame


def history_rows(mapped: DataFrame) -> DataFrame:
    """Mapped records as input of the history merge: one row per key and start."""
    versions = latest_per_key(mapped, [history.KEY, history.START], [history.CHANGE])
    return versions.drop(history.CURRENT, history.END)


def last_processed(control: DataFrame, source_table: str):
    """The stored bound of a source table, or None before its first load."""
    row = control.filter(F.col("table_name") == source_table).select("last_processed_date").first()
    return row[0] if row else None


def departures(
    changed: DataFrame,
    open_keys: DataFrame | None,
    source: DataFrame,
    statuses: tuple[str, ...],
    now: Column | None,
    whole: bool,
) -> DataFrame:
    """(key, start) of records that left the extract.

    A changed record whose status is not extracted left when it changed. Where the source is
    whole, a key that is open in the history and not among the extracted records has vanished
    by now; the two key sets are compared by digests, so only buckets that differ are read
    key by key.
    """
    wanted = F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    kind = source.schema[DATES[0]].dataType
    left = changed.filter(~wanted).select(
        F.col(KEY).alias(history.KEY), F.coalesce(DATES[1], DATES[0]).alias(history.START)
    )
    if not whole or open_keys is None:
        return left
    vanished = digests.only_left(open_keys, source.filter(wanted), history.KEY, KEY)
    at = (F.current_timestamp() if now is None else now).cast(kind)
    vanished = vanished.join(left.select(history.KEY), history.KEY, "left_anti")
    return left.unionByName(vanished.withColumn(history.START, at))


def run_increment(
    source: DataFrame,
    parent: DataFrame,
    parent_key: str,
    folder: str,
    source_table: str,
    batch_id: str,
    change_key: str,
    since: Column | None = None,
    masks: Mapping[str, str] | None = None,
    now: Column | None = None,
    threshold: float = QUALITY_THRESHOLD,
    statuses: tuple[str, ...] = EXTRACT_STATUSES,
    fmt: str = "parquet",
    whole: bool = False,
) -> Loaded:
    """Extract, check, map and merge the records created or updated since the bound.

    Without ``since`` the stored watermark of the source is the bound, kept for the batch so
    that it takes the same records when run again; the first load takes all records. Records
    at the bound are taken again, as others of the same time may have come later; the merge
    ignores what it knows. The extract is stored once and all later steps read it.
    ``change_key`` is the secret of the hash that tells versions apart; the history needs the
    same one on every run. A quality score below the threshold fails the run before anything
    reaches the history. A version starts when its record was last changed. Records that turn
    to another status are closed in the history; ``whole`` says that ``source`` holds all
    records, so that those missing from it are closed too. An extract without records and
    departures changes nothing. History, lineage and watermark are the same however often a
    batch runs.
    """
    spark = source.sparkSession
    control_path = f"{folder}/control"
    control = scan_path(spark, control_path, fmt) if history.exists(source, control_path) else None
    if since is None and control is not None:
        bound_path = f"{folder}/bounds/{batch_id}"
        if not history.exists(source, bound_path):
            write_path(control, bound_path, fmt=fmt)
        bound = last_processed(scan_path(spark, bound_path, fmt), source_table)
        since = None if bound is None else F.lit(bound).cast(source.schema[DATES[0]].dataType)
    changed = source if since is None else governance.changed_since(source, since, DATES, inclusive=True)
    tagged = tag_extract(changed, source_table, batch_id, now, statuses)
    extract = write_path(tagged, f"{folder}/extract/{batch_id}", fmt=fmt)
    history_path, lineage_path = f"{folder}/history", f"{folder}/lineage"

    def mapped(score: Column) -> DataFrame:
        scored = extract.withColumns(
            {
                "data_quality_score": score.cast("decimal(5,2)"),
                "created_date": F.coalesce("updated_date", "created_date"),
            }
        )
        return governance.map_source_secure(scored, masks, now, change_key=change_key)

    unscored = history_rows(mapped(F.lit(None)))
    schema = history.first_versions(unscored).schema
    known = history.exists(source, f"{history_path}/_runs")
    keys = history.open_keys(spark, history_path, schema, fmt) if known and whole else None
    left = departures(changed, keys, source, statuses, now, whole)
    left = write_path(left, f"{folder}/departed/{batch_id}", fmt=fmt)
    if extract.isEmpty() and control is not None:
        if left.isEmpty():
            stored = history.read_stored(spark, history_path, schema, fmt)
        else:
            stored = history.merge_stored(unscored, history_path, f"{folder}/merged/{batch_id}", fmt=fmt, departed=left)
        return Loaded(stored, scan_path(spark, lineage_path, fmt), control)
    gate = quality_gate(extract, [KEY], parent, parent_key, KEY, now, threshold)
    gate = write_path(gate, f"{folder}/quality/{batch_id}", fmt=fmt)
    require(gate, "is_valid")

    rows = mapped(gate.select("data_quality_score").scalar() * 100)
    stored = history.merge_stored(
        history_rows(rows), history_path, f"{folder}/merged/{batch_id}", fmt=fmt, departed=left
    )
    lineage = governance.lineage_rows(
        rows, "business_key", source_table, "history", "map_source_secure", batch_id,
        F.col("data_quality_score"), now,
    )
    lineage = replace_partition(lineage, lineage_path, "batch_id", batch_id, fmt)
    mark = governance.new_watermark(extract, source_table, DATES, now)
    mark = mark if control is None else governance.upsert_watermark(control, mark)
    mark = write_path(mark, f"{folder}/marks/{batch_id}", fmt=fmt)
    mark = write_path(mark, control_path, fmt=fmt)
    for name in ("marks", "departed"):
        keyed.remove(spark, f"{folder}/{name}/{batch_id}")
    return Loaded(stored, lineage, mark)
