"""Scans and sinks. A sink writes below the shared folder and reads the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators.projections import with_constants
from tallyline.plans import amendments, domain, regulatory
from tallyline.plans.engagement import INTERSTITIAL_MEASURES, TILE_MEASURES, run_arrivals
from tallyline.queries.basics import RECORD_COLUMNS, _branch_summary, now, stamp
from tallyline.queries.events import _events
from tallyline.queries.registry import DAY, register
from tallyline.queries.reports import _AML, branch_report, day_summary
from tallyline.queries.views import daily_summary, query
from tallyline.sources import readers, writers
from tallyline.sources.workspace import new_path

_MEASURES = """unique_tile_views, unique_tile_clicks, unique_interstitial_views,
    unique_interstitial_primary_clicks, unique_interstitial_secondary_clicks"""
_REPORT = "BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT, REGION, LAST_AUDIT_DATE"
NULL = "\\N"


@register(
    "scan_table",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               {stamp("o_orderdate")} AS o_orderdate, o_orderpriority FROM orders""",
)
def scan_table(spark, folder):
    domain.table(spark, folder, "orders").createOrReplaceTempView("tallyline_orders")
    return readers.scan_table(spark, "tallyline_orders")


@register(
    "scan_pipe_csv",
    query("""SELECT kafka_key, kafka_partition, kafka_offset, ingest_ts,
                    'x|"y"' || chr(10) || chr(92) || 'n' || chr(13) || coalesce(payload_json, '') AS payload_json
             FROM landing WHERE kafka_offset % 2 = 0
             UNION ALL SELECT * FROM landing WHERE kafka_offset % 2 = 1"""),
)
def scan_pipe_csv(spark, folder):
    """Landing rows, half of them with delimiters, quotes, backslashes and line breaks added, and back."""
    path = new_path(spark, "landing")
    odd = F.concat(F.lit('x|"y"\n\\n\r'), F.coalesce("payload_json", F.lit("")))
    rows = domain.landing(spark, folder).withColumn(
        "payload_json", F.when(F.col("kafka_offset") % 2 == 0, odd).otherwise(F.col("payload_json"))
    )
    writers.write_pipe_csv(rows, path, null_value=NULL)
    return readers.scan_pipe_csv(spark, path, schemas.schema("landing_event"), null_value=NULL)


@register("scan_path", "SELECT * FROM customer")
def scan_path(spark, folder):
    return readers.scan_path(spark, f"{folder}/customer.parquet")


@register(
    "scan_incremental",
    query(f"""SELECT id, column1, CAST(column3 AS DOUBLE) AS column3,
                     {stamp("created_date")} AS created_date
              FROM source_records WHERE created_date >= TIMESTAMP '2000-01-01'"""),
)
def scan_incremental(spark, folder):
    return readers.scan_incremental(
        domain.source_records(spark, folder),
        "created_date",
        F.lit("2000-01-01").cast("timestamp_ntz"),
        ["id", "column1", "column3", "created_date"],
    )


@register(
    "scan_incremental_tagged",
    query(f"""SELECT {RECORD_COLUMNS}, '2026-01-15 08:30:00.000000' AS extraction_timestamp,
                     'sales.orders' AS source_table, 'BATCH_1' AS extraction_batch_id
              FROM source_records WHERE created_date >= TIMESTAMP '2000-01-01'
              AND status IN ('ACTIVE', 'PENDING')"""),
)
def scan_incremental_tagged(spark, folder):
    return readers.scan_incremental_tagged(
        domain.source_records(spark, folder),
        "created_date",
        F.lit("2000-01-01").cast("timestamp_ntz"),
        "sales.orders",
        "BATCH_1",
        extracted_at=now(),
        order=["created_date", "id"],
    )


@register(
    "sink_overwrite_table",
    query("SELECT BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT FROM summary"),
)
def sink_overwrite_table(spark, folder):
    """Written twice; the second content stays."""
    name = f"tallyline_branch_summary_{uuid.uuid4().hex}"
    path = new_path(spark, name)
    summary = _branch_summary(spark, folder)
    writers.overwrite_table(summary.filter(F.col("TOTAL_TRANSACTIONS") < 0), name, path=path)
    return writers.overwrite_table(summary, name, path=path)


@register(
    "sink_overwrite_evolving",
    query(f"""SELECT CAST(BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
                     TOTAL_AMOUNT, NULL AS REGION, NULL AS LAST_AUDIT_DATE FROM summary
              UNION ALL SELECT {_REPORT} FROM report"""),
)
def sink_overwrite_evolving(spark, folder):
    """A report without the later columns, then one with them, under the same path."""
    path = new_path(spark, "evolving")
    writers.write_path(regulatory.report_types(_branch_summary(spark, folder)), path)
    return writers.write_evolving(branch_report(spark, folder), path)


_PART = """CASE l_orderkey % 6 WHEN 0 THEN 'A&B' WHEN 1 THEN '007' WHEN 2 THEN 'ü b' WHEN 3 THEN 'a=b/c'
    WHEN 4 THEN '2024-01-05' END"""


@register(
    "sink_partitioned_verified",
    f"SELECT l_orderkey, l_linenumber, {_PART} AS part FROM lineitem",
)
def sink_partitioned_verified(spark, folder):
    """Line items by a text whose values look like numbers and dates, hold signs, or are NULL."""
    rows = domain.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_PART).alias("part"))
    path = new_path(spark, "partitioned")
    writers.write_verified(rows, path, partition_by=["part"])
    return writers.read_back(rows, path)


_DAYS = ("2024-01-04", DAY, "2024-01-06")


@register(
    "sink_replace_partition",
    query(f"""SELECT CAST(date AS VARCHAR) AS date, tile_id, {_MEASURES} FROM first_day
              UNION ALL SELECT CAST(date AS VARCHAR), tile_id, {_MEASURES} FROM second_day""",
          first_day=daily_summary(_DAYS[0]), second_day=daily_summary(_DAYS[1])),
)
def sink_replace_partition(spark, folder):
    """Three days, of which one is written again and one replaced by an empty day."""
    path = new_path(spark, "daily")
    for day in (*_DAYS, DAY):
        writers.replace_partition(day_summary(spark, folder, day), path, "date", day)
    empty = day_summary(spark, folder, "1999-01-01")
    return writers.replace_partition(empty, path, "date", _DAYS[2])


@register(
    "sink_replace_partition_text",
    f"""SELECT l_orderkey, l_linenumber, part, CASE WHEN part = 'A&B' THEN 2 WHEN part IS NULL THEN 3 ELSE 1 END AS run
        FROM (SELECT l_orderkey, l_linenumber, {_PART} AS part FROM lineitem)
        WHERE part IS NULL OR part <> 'a=b/c'""",
)
def sink_replace_partition_text(spark, folder):
    """A text partition column: two values replaced, NULL among them, and one emptied."""
    rows = domain.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_PART).alias("part"))
    path = new_path(spark, "by-text")
    writers.write_path(with_constants(rows, run=1), path, partition_by=["part"])
    writers.replace_partition(with_constants(rows, run=2), path, "part", "A&B")
    writers.replace_partition(with_constants(rows, run=3), path, "part", None)
    none = with_constants(rows, run=4).filter("l_orderkey < 0")
    return writers.replace_partition(none, path, "part", "a=b/c")


def _late_sql(events: str, measures: dict[str, str]) -> str:
    counts = ", ".join(
        f"count(DISTINCT CASE WHEN {sql} THEN user_id END) AS {name}" for name, sql in measures.items()
    )
    return f"SELECT CAST(event_ts AS DATE) AS date, tile_id, {counts} FROM {events} WHERE event_ts IS NOT NULL GROUP BY ALL"


@register(
    "sink_late_days",
    query(f"""SELECT CAST(coalesce(t.date, i.date) AS VARCHAR) AS date, coalesce(t.tile_id, i.tile_id) AS tile_id,
                {", ".join(f"coalesce({m}, 0) AS {m}" for m in [*TILE_MEASURES, *INTERSTITIAL_MEASURES])}
              FROM ({_late_sql("tile_events", TILE_MEASURES)}) t
              FULL JOIN ({_late_sql("interstitial_events", INTERSTITIAL_MEASURES)}) i
              ON t.date = i.date AND t.tile_id = i.tile_id"""),
)
def sink_late_days(spark, folder):
    """All days of what came in time, then the days that late events belong to."""
    late = F.lit("2030-01-01").cast("timestamp")
    events = [
        rows.withColumn(
            "arrived_ts", F.when(F.col("event_id").cast("long") % 97 == 0, late).otherwise(F.col("event_ts"))
        )
        for rows in (domain.tile_events(spark, folder), domain.interstitial_events(spark, folder))
    ]
    path = new_path(spark, "late")
    in_time = [rows.filter(F.col("arrived_ts") < late) for rows in events]
    run_arrivals(*in_time, path, "arrived_ts")
    return run_arrivals(*events, path, "arrived_ts", late).daily.select(
        F.col("date").cast("string").alias("date"), "tile_id", *TILE_MEASURES, *INTERSTITIAL_MEASURES
    )


@register("sink_pipe_csv", query("SELECT * FROM rejects"))
def sink_pipe_csv(spark, folder):
    landing, template = domain.landing(spark, folder), domain.template(spark)
    assessed = amendments.assess(amendments.extract_event_meta(landing), template)
    rejects = amendments.rejects_of(assessed).drop("processing_ts")
    path = new_path(spark, "rejects")
    writers.write_pipe_csv(rejects, path, null_value=NULL)
    return readers.scan_pipe_csv(spark, path, rejects.schema, null_value=NULL)


@register(
    "sink_append",
    query("""SELECT kafka_offset, event_id, 1 AS batch FROM meta
             UNION ALL SELECT kafka_offset, event_id, 2 FROM meta"""),
)
def sink_append(spark, folder):
    events = _events(spark, folder).select("kafka_offset", "event_id")
    path = new_path(spark, "appended")
    writers.append_path(with_constants(events, batch=1), path)
    return writers.append_path(with_constants(events, batch=2), path)


@register("sink_ordered_columns", query(f"SELECT {_REPORT} FROM report"))
def sink_ordered_columns(spark, folder):
    columns = schemas.schema("branch_summary_report").fieldNames()
    shuffled = branch_report(spark, folder).select(*reversed(columns))
    return writers.write_ordered(shuffled, columns, new_path(spark, "ordered"))
