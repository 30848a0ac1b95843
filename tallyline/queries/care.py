"""Mappings, protection, incremental load, history and schema changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.protection import change_hash
from tallyline.operators import governance, history, monitoring
from tallyline.operators.sets import consolidate, union_all
from tallyline.plans import domain, increment
from tallyline.queries.basics import RECORD_COLUMNS, _branch_summary, as_of, now, stamp
from tallyline.queries.registry import DAY, register
from tallyline.queries.reports import branch_report, enriched_summary
from tallyline.queries.views import daily_summary, query
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path

_NOW = "'2026-01-15 08:30:00.000000'"
_FOUR_WAY = """CASE status WHEN 'ACTIVE' THEN 'A' WHEN 'INACTIVE' THEN 'I'
    WHEN 'PENDING' THEN 'P' ELSE 'U' END"""


@register(
    "transform_new_source",
    query(f"""SELECT id AS new_source_id, upper(column1) AS new_source_column1,
                trim(column2) AS new_source_column2,
                CAST(round(column3, 2) AS DOUBLE) AS new_source_column3,
                {stamp("created_date")} AS source_created_date,
                CASE WHEN status = 'ACTIVE' THEN 'A' ELSE 'I' END AS record_status,
                'NEW_SOURCE' AS source_system, {_NOW} AS load_timestamp
              FROM source_records"""),
)
def transform_new_source(spark, folder):
    return governance.map_source(domain.source_records(spark, folder), now())


def _extracted(spark, folder, records=None):
    rows = domain.source_records(spark, folder) if records is None else records
    return rows.withColumns(
        {
            "data_quality_score": F.lit("98.50").cast("decimal(5,2)"),
            "extraction_batch_id": F.lit("BATCH_1"),
        }
    )


@register(
    "transform_new_source_secure",
    query(f"""SELECT id AS business_key,
                coalesce(upper(trim(column1)), 'UNKNOWN') AS new_source_column1,
                coalesce(trim(column2), 'UNKNOWN') AS new_source_column2,
                CAST(CASE WHEN column3 BETWEEN 0 AND 999999.99 THEN round(column3, 2) END
                     AS DOUBLE) AS new_source_column3,
                {stamp("created_date")} AS effective_start_date, {_FOUR_WAY} AS record_status,
                'NEW_SOURCE' AS source_system, {_NOW} AS created_timestamp, true AS is_current,
                '9999-12-31 23:59:59.000000' AS effective_end_date, CAST(98.5 AS DOUBLE) AS data_quality_score,
                md5(concat_ws('|', CAST(id AS VARCHAR), column1, column2,
                              CAST(column3 AS VARCHAR))) AS source_checksum,
                'BATCH_1' AS batch_id, 'INTERNAL' AS data_classification,
                CAST(DATE '2026-01-15' + 2555 AS VARCHAR) AS retention_date
              FROM (SELECT id, substr(column1, 1, 2) || '***' AS column1,
                           sha256(column2) AS column2, column3, status, created_date
                    FROM source_records)"""),
)
def transform_new_source_secure(spark, folder):
    masks = {"column1": "PARTIAL_MASK", "column2": "HASH"}
    return governance.map_source_secure(_extracted(spark, folder), masks, now(), as_of())


@register(
    "mask_columns",
    query("""SELECT id, substr(column1, 1, 2) || '***' AS column1, sha256(column2) AS column2,
                    substr(status, 1, 4) || '****' AS status FROM source_records"""),
)
def mask_columns(spark, folder):
    rows = domain.source_records(spark, folder).select("id", "column1", "column2", "status")
    masks = {
        "column1": "PARTIAL_MASK",
        "column2": "HASH",
        "status": "PREFIX_MASK",
        "absent": "HASH",
    }
    return governance.mask_columns(rows, masks)


@register(
    "anonymize_expired",
    query("""SELECT id, CASE WHEN CAST(created_date AS DATE) + 2555 < DATE '2004-01-01'
                             THEN 'ANONYMIZED' ELSE column1 END AS new_source_column1,
                    CAST(CAST(created_date AS DATE) + 2555 AS VARCHAR) AS retention_date
             FROM source_records"""),
)
def anonymize_expired(spark, folder):
    rows = domain.source_records(spark, folder).select(
        "id",
        F.col("column1").alias("new_source_column1"),
        F.date_add(F.to_date("created_date"), 2555).alias("retention_date"),
    )
    return governance.anonymize_expired(rows, F.lit("2004-01-01").cast("date"))


@register(
    "delete_expired",
    query("""SELECT TRANSACTION_ID, CAST(TRANSACTION_DATE AS VARCHAR) AS TRANSACTION_DATE
             FROM transactions
             WHERE NOT TRANSACTION_DATE < CAST(DATE '2005-02-28' - INTERVAL 7 YEAR AS DATE)"""),
)
def delete_expired(spark, folder):
    rows = domain.transactions(spark, folder).select("TRANSACTION_ID", "TRANSACTION_DATE")
    kept = governance.without_expired(
        rows, "TRANSACTION_DATE", F.lit("2005-02-28").cast("date")
    )
    return write_path(kept, new_path(spark, "delete_expired"))


@register(
    "incremental_predicate",
    query(f"""SELECT {RECORD_COLUMNS} FROM source_records
              WHERE created_date > TIMESTAMP '2000-06-01' OR updated_date > TIMESTAMP '2000-06-01'"""),
)
def incremental_predicate(spark, folder):
    since = F.lit("2000-06-01").cast("timestamp_ntz")
    return governance.changed_since(domain.source_records(spark, folder), since)


@register(
    "upsert_watermark",
    query(f"""SELECT 'orders' AS table_name,
                     {stamp("max(greatest(created_date, coalesce(updated_date, created_date)))")}
                         AS last_processed_date,
                     {_NOW} AS updated_timestamp FROM source_records
              UNION ALL SELECT 'events', {stamp("max(ts)")}, '2026-01-14 00:00:00.000000'
              FROM events"""),
)
def upsert_watermark(spark, folder):
    """Two marks of an earlier run, of which one is replaced; an empty and a late batch change nothing."""
    before = F.lit("2026-01-14").cast("timestamp_ntz")
    records = domain.source_records(spark, folder)
    events = domain.table(spark, folder, "events")
    first = records.filter(F.col("created_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
    control = union_all(
        [
            governance.new_watermark(first, "orders", increment.DATES, before),
            governance.new_watermark(events, "events", "ts", before),
        ]
    )
    later = F.lit("2026-01-16").cast("timestamp_ntz")
    updates = [
        governance.new_watermark(records, "orders", increment.DATES, now()),
        governance.new_watermark(records.filter("id < 0"), "orders", increment.DATES, later),
        governance.new_watermark(first, "orders", increment.DATES, later),
    ]
    for update in updates:
        control = governance.upsert_watermark(control, update)
    return control


# State of a record in a batch, its time, and the batch: the early records; most records with the
# status of pending ones changed; their masked second column changed, for some; a version from
# before the first one, which comes late.
_VERSIONS = """
  SELECT id, column1, column2, status, created_date AS start FROM source_records
  WHERE created_date < TIMESTAMP '2000-01-01'
  UNION ALL
  SELECT id, column1, column2, CASE WHEN status = 'PENDING' THEN 'INACTIVE' ELSE status END,
         TIMESTAMP '2026-01-15 08:30:00' FROM source_records WHERE status <> 'SUSPENDED'
  UNION ALL
  SELECT id, column1, coalesce(column2, '') || '-x',
         CASE WHEN status = 'PENDING' THEN 'INACTIVE' ELSE status END, TIMESTAMP '2026-01-16 08:30:00'
  FROM source_records WHERE status <> 'SUSPENDED' AND id % 3 = 0
  UNION ALL
  SELECT id, 'older', column2, status, TIMESTAMP '1980-01-01' FROM source_records WHERE id % 5 = 0"""


@register(
    "scd2_merge",
    query(f"""
      SELECT business_key, new_source_column1, shown, record_status,
             {stamp("start")} AS effective_start_date,
             coalesce({stamp("lead(start) OVER (PARTITION BY business_key ORDER BY start)")},
                      '9999-12-31 23:59:59.000000') AS effective_end_date,
             lead(start) OVER (PARTITION BY business_key ORDER BY start) IS NULL AS is_current
      FROM (
        SELECT id AS business_key, column1 AS new_source_column1, left(column2, 1) || '***' AS shown,
               status AS record_status, start,
               lag([column1, column2, status]) OVER (PARTITION BY id ORDER BY start)
                   IS DISTINCT FROM [column1, column2, status] AS is_new
        FROM versions) WHERE is_new""",
          versions=_VERSIONS),
)
def scd2_merge(spark, folder):
    """Four batches, the last one late and one run twice; the second column is masked in the history."""
    records = domain.source_records(spark, folder).select("id", "column1", "column2", "status", "created_date")

    def versions(rows, start):
        return rows.select(
            F.col("id").alias("business_key"),
            F.col("column1").alias("new_source_column1"),
            F.concat(F.substring("column2", 1, 1), F.lit("***")).alias("shown"),
            F.col("status").alias("record_status"),
            start.cast("timestamp_ntz").alias("effective_start_date"),
            change_hash(["id", "column1", "column2", "status"]).alias(history.CHANGE),
        )

    early = records.filter(F.col("created_date") < F.lit("2000-01-01").cast("timestamp_ntz"))
    inactive = F.when(F.col("status") == "PENDING", F.lit("INACTIVE")).otherwise(F.col("status"))
    later = records.filter("status <> 'SUSPENDED'").withColumn("status", inactive)
    masked = later.filter("id % 3 = 0").withColumn("column2", F.concat(F.coalesce("column2", F.lit("")), F.lit("-x")))
    late = records.filter("id % 5 = 0").withColumn("column1", F.lit("older"))
    batches = [
        versions(later, F.lit("2026-01-15 08:30:00")),
        versions(masked, F.lit("2026-01-16 08:30:00")),
        versions(later, F.lit("2026-01-15 08:30:00")),
        versions(late, F.lit("1980-01-01 00:00:00")),
    ]
    state = history.first_versions(versions(early, F.col("created_date")))
    for batch in batches:
        # hexadecimal hashes are most of a row, and zstd halves them
        state = write_path(history.scd2_merge(state, batch), new_path(spark, "merged"), codec="zstd")
    return state.drop(history.SURROGATE, history.CHANGE)


@register(
    "lineage_columns",
    query(f"""SELECT id, 'ORDERS' AS source_system, 'mapping v2' AS transformation_applied,
                     {_NOW} AS processing_timestamp FROM source_records"""),
)
def lineage_columns(spark, folder):
    rows = domain.source_records(spark, folder).select("id")
    return governance.with_lineage(rows, "ORDERS", "mapping v2", now())


@register(
    "lineage_rows",
    query(f"""SELECT md5('target|' || id || '|BATCH_1') AS lineage_id, 'orders' AS source_table,
                'target' AS target_table, id AS record_id, 'mapping v2' AS transformation_applied,
                {_NOW} AS processed_timestamp, 'BATCH_1' AS batch_id, CAST(98.5 AS DOUBLE) AS data_quality_score
              FROM source_records"""),
)
def lineage_rows(spark, folder):
    mapped = governance.map_source(domain.source_records(spark, folder), now())
    return governance.lineage_rows(
        mapped,
        "new_source_id",
        "orders",
        "target",
        "mapping v2",
        "BATCH_1",
        F.lit("98.50"),
        now(),
    )


@register(
    "audit_rows",
    query(f"""SELECT 'WRITE' AS operation, 'transactions' AS table_name, count(*) AS record_count,
                CAST(1.5 AS DOUBLE) AS processing_time_seconds, 'loader' AS user, {_NOW} AS timestamp,
                'reporting' AS application, '1.0' AS version FROM transactions
              UNION ALL SELECT 'WRITE', 'branch_summary', count(*), CAST(1.5 AS DOUBLE), 'loader', {_NOW},
                'reporting', '1.0' FROM summary"""),
)
def audit_rows(spark, folder):
    """An audit table to which each written table adds a row."""
    log = new_path(spark, "audit_log")
    written = {
        "transactions": domain.transactions(spark, folder),
        "branch_summary": _branch_summary(spark, folder),
    }
    for name, rows in written.items():
        stored = write_path(rows, new_path(spark, name))
        entry = monitoring.audit_row(
            stored, "WRITE", name, "loader", "reporting", "1.0", seconds=1.5, now=now()
        )
        audit = write_path(entry, log, mode="append")
    return audit


_DAY_SUMMARY = {
    "day_summary": daily_summary(DAY),
    "enriched": """SELECT s.*, m.tile_category FROM day_summary s
        LEFT JOIN current_metadata m ON s.tile_id = m.tile_id""",
}


@register(
    "backfill_tile_category",
    query("""SELECT e.tile_id, coalesce(e.tile_category, m.tile_category, 'UNKNOWN')
                 AS tile_category, unique_tile_views
             FROM enriched e LEFT JOIN metadata m ON e.tile_id = m.tile_id""", **_DAY_SUMMARY),
)
def backfill_tile_category(spark, folder):
    """Categories of active tiles are known already, the others are filled in."""
    known = enriched_summary(spark, folder).select(
        "tile_id",
        F.nullif("tile_category", F.lit("UNKNOWN")).alias("tile_category"),
        "unique_tile_views",
    )
    return governance.backfill_category(known, domain.tile_metadata(spark, folder))


@register(
    "backfill_branch_details",
    query("""SELECT r.BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT,
               CASE WHEN r.REGION IS NULL OR r.LAST_AUDIT_DATE IS NULL
                    THEN coalesce(d.REGION, 'UNKNOWN') ELSE r.REGION END AS REGION,
               CASE WHEN r.REGION IS NULL OR r.LAST_AUDIT_DATE IS NULL
                    THEN coalesce(CAST(d.LAST_AUDIT_DATE AS VARCHAR), 'NOT_AVAILABLE')
                    ELSE r.LAST_AUDIT_DATE END AS LAST_AUDIT_DATE
             FROM report r LEFT JOIN details d ON r.BRANCH_ID = d.BRANCH_ID"""),
)
def backfill_branch_details(spark, folder):
    return governance.backfill_branch_details(
        branch_report(spark, folder), domain.branch_details(spark, folder)
    )


@register(
    "evolve_schema",
    query("""SELECT CAST(BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
                    TOTAL_AMOUNT, 'UNKNOWN' AS REGION, CAST(NULL AS VARCHAR) AS LAST_AUDIT_DATE
             FROM summary"""),
)
def evolve_schema(spark, folder):
    target = schemas.schema("branch_summary_report")
    return governance.evolve_schema(_branch_summary(spark, folder), target, {"REGION": "UNKNOWN"})


@register(
    "drop_columns",
    query("SELECT BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT FROM report"),
)
def drop_columns(spark, folder):
    kept = governance.drop_columns(branch_report(spark, folder), ["REGION", "LAST_AUDIT_DATE"])
    return write_path(kept, new_path(spark, "drop_columns"))


@register(
    "consolidate_sources",
    query("""SELECT 'orders' AS source_table, id AS new_source_id, status, CAST(NULL AS DOUBLE) AS balance
             FROM source_records
             UNION ALL SELECT 'supplier', s_suppkey, NULL, s_acctbal FROM supplier"""),
)
def consolidate_sources(spark, folder):
    orders = domain.source_records(spark, folder).select(
        F.col("id").alias("new_source_id"), "status"
    )
    suppliers = domain.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("new_source_id"), F.col("s_acctbal").alias("balance")
    )
    return consolidate({"orders": orders, "supplier": suppliers}).select(
        "source_table", "new_source_id", "status", "balance"
    )




_CHANGED = "2026-01-10 00:00:00"


@register(
    "increment_job",
    query(f"""
      SELECT business_key, new_source_column1, record_status, {stamp("start")} AS effective_start_date,
             is_current, lineage_rows, lineage_rows AS lineage_ids, {stamp("last_processed")} AS last_processed
      FROM (
        SELECT id AS business_key, upper(trim(column1)) AS new_source_column1,
               CASE status WHEN 'ACTIVE' THEN 'A' ELSE 'P' END AS record_status,
               coalesce(updated_date, created_date) AS start, status <> 'PENDING' AS is_current
        FROM wanted
        UNION ALL
        SELECT id, upper(trim(column1)) || ' CHANGED', 'P', TIMESTAMP '{_CHANGED}', true
        FROM wanted WHERE status = 'PENDING') JOIN totals ON true""",
          wanted="SELECT * FROM source_records WHERE status IN ('ACTIVE', 'PENDING')",
          mark="""SELECT max(greatest(created_date, coalesce(updated_date, created_date))) AS bound FROM wanted""",
          totals=f"""SELECT count(*) + count(*) FILTER (WHERE status = 'PENDING'
                     OR created_date >= bound OR updated_date >= bound) AS lineage_rows,
                 greatest(any_value(bound), TIMESTAMP '{_CHANGED}') AS last_processed FROM wanted JOIN mark ON true"""),
)
def increment_job(spark, folder):
    """A first load, changes of old records, the same batch again, and an empty one.

    Five of the six checks pass, as amounts out of range are planted, so the threshold is
    lower than usual.
    """
    records, pending = domain.source_records(spark, folder), F.col("status") == "PENDING"
    later = F.lit(_CHANGED).cast("timestamp_ntz")
    changed = records.withColumns(
        {
            "column1": F.when(pending, F.concat("column1", F.lit(" changed"))).otherwise(F.col("column1")),
            "updated_date": F.when(pending, later).otherwise(F.col("updated_date")),
        }
    )
    path, parent = new_path(spark, "increment"), domain.table(spark, folder, "orders")
    batches = (("B1", records), ("B2", changed), ("B2", changed), ("B3", changed.filter("id < 0")))
    for batch, rows in batches:
        loaded = increment.run_increment(
            rows, parent, "o_orderkey", path, "orders", batch, "secret", now=now(), threshold=0.8
        )
    lineage = loaded.lineage.agg(
        F.count("*").alias("lineage_rows"), F.count_distinct("lineage_id").alias("lineage_ids")
    )
    mark = loaded.watermark.select("last_processed_date")
    return loaded.history.select(
        "business_key",
        "new_source_column1",
        "record_status",
        "effective_start_date",
        "is_current",
        lineage.select("lineage_rows").scalar().alias("lineage_rows"),
        lineage.select("lineage_ids").scalar().alias("lineage_ids"),
        mark.scalar().alias("last_processed"),
    )


@register(
    "increment_departures",
    query(f"""SELECT id AS business_key, CASE status WHEN 'ACTIVE' THEN 'A' ELSE 'P' END AS record_status,
                {stamp("coalesce(updated_date, created_date)")} AS effective_start_date,
                CASE WHEN id % 10 = 2 THEN {_NOW} WHEN id % 10 = 1 AND status = 'ACTIVE' THEN '{_CHANGED}.000000'
                     ELSE '9999-12-31 23:59:59.000000' END AS effective_end_date,
                NOT (id % 10 = 2 OR id % 10 = 1 AND status = 'ACTIVE') AS is_current
              FROM source_records WHERE status IN ('ACTIVE', 'PENDING')"""),
)
def increment_departures(spark, folder):
    """A first load, then records that turn inactive and records that vanish, loaded twice."""
    records = domain.source_records(spark, folder)
    turned = (F.col("id") % 10 == 1) & (F.col("status") == "ACTIVE")
    later = records.filter("id % 10 <> 2").withColumns(
        {
            "updated_date": F.when(turned, F.lit(_CHANGED).cast("timestamp_ntz")).otherwise(F.col("updated_date")),
            "status": F.when(turned, F.lit("INACTIVE")).otherwise(F.col("status")),
        }
    )
    path, parent = new_path(spark, "departures"), domain.table(spark, folder, "orders")
    for batch, rows in (("B1", records), ("B2", later), ("B2", later)):
        loaded = increment.run_increment(
            rows, parent, "o_orderkey", path, "orders", batch, "secret", now=now(), threshold=0.8, whole=True
        )
    return loaded.history.select(
        "business_key", "record_status", "effective_start_date", "effective_end_date", "is_current"
    )
