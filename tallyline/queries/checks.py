"""Data quality, reconciliation and monitoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import clustering, monitoring, quality, reconciliation
from tallyline.operators.sets import union_all
from tallyline.plans import amendments, domain
from tallyline.queries.basics import _branch_summary
from tallyline.queries.registry import register
from tallyline.queries.reports import branch_report
from tallyline.queries.views import query
from tallyline.sources.readers import table_or_empty
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path


def _turn_of_century():
    return F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")


@register(
    "dq_basic",
    query("""SELECT 'BRANCH_SUMMARY_REPORT' AS table_name, count(*) AS row_count,
                    count(*) FILTER (WHERE BRANCH_ID IS NULL) AS null_keys,
                    count(*) > 0 AND count(*) FILTER (WHERE BRANCH_ID IS NULL) = 0 AS passed
             FROM report
             UNION ALL SELECT 'TILE_EVENTS', count(*), count(*) FILTER (WHERE tile_id IS NULL),
                    count(*) > 0 AND count(*) FILTER (WHERE tile_id IS NULL) = 0
             FROM tile_events"""),
)
def dq_basic(spark, folder):
    report = branch_report(spark, folder)
    tiles = domain.tile_events(spark, folder)
    return union_all(
        [
            quality.basic_check(report, "BRANCH_SUMMARY_REPORT", ["BRANCH_ID"]),
            quality.basic_check(tiles, "TILE_EVENTS", ["tile_id"]),
        ]
    )


def _integrity_sql(table: str, source: str, key: str, negative: str) -> str:
    return f"""SELECT *, row_count > 0 AND null_keys = 0 AND negative_rows = 0 AS passed FROM (
        SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count,
               CAST(coalesce(sum(CASE WHEN {key} IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
               count(*) FILTER (WHERE n > 1) AS duplicated_keys,
               CAST(sum(bad) AS BIGINT) AS negative_rows
        FROM (SELECT {key}, count(*) AS n, count(*) FILTER (WHERE {negative}) AS bad
              FROM {source} GROUP BY {key}))"""


@register(
    "dq_integrity",
    query(
        _integrity_sql("BRANCH_SUMMARY_REPORT", "report", "BRANCH_ID", "TOTAL_AMOUNT < 0")
        + " UNION ALL "
        + _integrity_sql("SOURCE_RECORDS", "source_records", "id", "column3 < 0")
        + " UNION ALL "
        + _integrity_sql("AML_CUSTOMER_TRANSACTIONS", "transactions", "ACCOUNT_ID", "AMOUNT < 0")
    ),
)
def dq_integrity(spark, folder):
    return union_all(
        [
            quality.integrity_check(
                branch_report(spark, folder), "BRANCH_SUMMARY_REPORT", ["BRANCH_ID"]
            ),
            quality.integrity_check(
                domain.source_records(spark, folder), "SOURCE_RECORDS", ["id"], ["column3"]
            ),
            quality.integrity_check(
                domain.transactions(spark, folder), "AML_CUSTOMER_TRANSACTIONS", ["ACCOUNT_ID"], ["AMOUNT"]
            ),
        ]
    )


RULES = [
    quality.Rule("id_not_null", "id IS NOT NULL"),
    quality.Rule("amount_positive", "column3 >= 0", "WARNING"),
    quality.Rule("status_known", "status IN ('ACTIVE', 'INACTIVE', 'PENDING')"),
    quality.Rule("update_after_creation", "updated_date >= created_date"),
]


def _rules_sql(source: str, rules, table: str) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{r.name}' AS rule_name, $${r.condition}$$ AS condition,
                   '{r.severity}' AS severity, count(*) AS total_records,
                   count(*) FILTER (WHERE NOT ({r.condition})) AS violations FROM {source}"""
        for r in rules
    )
    return f"""SELECT '{table}' AS table_name, total_records, rule_name, condition, severity,
                 violations, CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
                 CASE WHEN sum(CASE WHEN severity = 'ERROR' THEN violations END) OVER () = 0
                      THEN 'PASSED' ELSE 'FAILED' END AS overall_status
               FROM ({rows})"""


@register("dq_rules", query(_rules_sql("source_records", RULES, "SOURCE_RECORDS")))
def dq_rules(spark, folder):
    return quality.rule_check(domain.source_records(spark, folder), "SOURCE_RECORDS", RULES)


TAXONOMY = [quality.Rule("region_in_taxonomy", "REGION IN ('NORTH', 'SOUTH', 'EAST', 'WEST')")]


@register(
    "taxonomy_check",
    query(
        _rules_sql("regions", TAXONOMY, "CUSTOMER_REGIONS"),
        regions="""SELECT CASE r_name WHEN 'AFRICA' THEN 'SOUTH' WHEN 'ASIA' THEN 'EAST'
                          WHEN 'AMERICA' THEN 'WEST' WHEN 'EUROPE' THEN 'NORTH'
                          ELSE r_name END AS REGION
                   FROM customer JOIN nation ON c_nationkey = n_nationkey
                   JOIN region ON n_regionkey = r_regionkey""",
    ),
)
def taxonomy_check(spark, folder):
    """Regions of all customers, one of them outside the taxonomy."""
    regions = domain.table(spark, folder, "region")
    name = F.col("r_name")
    compass = (
        F.when(name == "AFRICA", "SOUTH")
        .when(name == "ASIA", "EAST")
        .when(name == "AMERICA", "WEST")
        .when(name == "EUROPE", "NORTH")
        .otherwise(name)
    )
    nations = domain.table(spark, folder, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = domain.table(spark, folder, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return quality.rule_check(
        customers.select(compass.alias("REGION")),
        "CUSTOMER_REGIONS",
        [quality.taxonomy_rule("REGION")],
    )


_REPORT_SCHEMA = [
    ("BRANCH_ID", "bigint", "0", "true"),
    ("BRANCH_NAME", "string", "nulls", "nulls = 0"),
    ("TOTAL_TRANSACTIONS", "bigint", "NULL", "true"),
    ("TOTAL_AMOUNT", "double", "NULL", "true"),
    ("REGION", "string", "NULL", "true"),
    ("LAST_AUDIT_DATE", "string", "NULL", "true"),
]


@register(
    "dq_required_schema",
    query(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, '{kind}' AS expected_type, '{kind}' AS actual_type,
                       CAST({value} AS BIGINT) AS null_count, {ok} AS passed FROM counted"""
            for name, kind, value, ok in _REPORT_SCHEMA
        ),
        counted="SELECT count(*) FILTER (WHERE BRANCH_NAME IS NULL) AS nulls FROM report",
    ),
)
def dq_required_schema(spark, folder):
    return quality.required_schema_check(
        branch_report(spark, folder),
        schemas.schema("branch_summary_report"),
        ["BRANCH_ID", "BRANCH_NAME"],
    )


_RECORD_COLUMNS = [
    "id", "column1", "column2", "column3", "status", "created_date", "updated_date",
    "created_by", "updated_by", "data_classification",
]


def _profile_sql() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
                   CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100
                       AS null_percentage,
                   {str(c in quality.CRITICAL_COLUMNS).lower()} AS is_critical
            FROM source_records"""
        for c in _RECORD_COLUMNS
    )
    return f"""SELECT *, null_percentage > 5.0 AS threshold_exceeded,
                 CASE WHEN bool_or(is_critical AND null_percentage > 5.0) OVER ()
                      THEN 'FAILED' ELSE 'PASSED' END AS status FROM ({rows})"""


@register("null_profile", query(_profile_sql()))
def null_profile(spark, folder):
    return quality.null_profile(domain.source_records(spark, folder))


@register(
    "duplicate_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def duplicate_check(spark, folder):
    lines = domain.table(spark, folder, "lineitem")
    return quality.duplicate_check(lines, ["l_orderkey", "l_linenumber"])


_RANGES = """SELECT count(*) AS total_records,
    count(*) FILTER (WHERE column3 NOT BETWEEN 0 AND 999999.99) AS out_of_range,
    count(*) FILTER (WHERE created_date > TIMESTAMP '2000-01-01') AS future_dated,
    count(*) FILTER (WHERE column2 IS NULL) AS defaulted_text FROM source_records"""


@register("range_and_date_checks", query(_RANGES))
def range_and_date_checks(spark, folder):
    return quality.range_and_date_check(domain.source_records(spark, folder), _turn_of_century())


@register(
    "amendment_quality_score",
    query("""SELECT *, round((total_records - null_event_ids - null_loan_ids - invalid_event_types
                    - missing_effective_dates - invalid_rates) / CAST(total_records AS DOUBLE)
                    * 100, 2) AS quality_score_percentage
             FROM (SELECT count(*) AS total_records,
                     count(*) FILTER (WHERE event_id = '') AS null_event_ids,
                     count(*) FILTER (WHERE loan_id = '') AS null_loan_ids,
                     count(*) FILTER (WHERE event_type <> 'MORTGAGE_AMENDMENT')
                         AS invalid_event_types,
                     count(*) FILTER (WHERE effective_date = '') AS missing_effective_dates,
                     count(*) FILTER (WHERE TRY_CAST(new_rate AS DOUBLE) < 0
                                      OR TRY_CAST(new_rate AS DOUBLE) > 50) AS invalid_rates
                   FROM canonical)"""),
)
def amendment_quality_score(spark, folder):
    events = amendments.extract_event_meta(domain.landing(spark, folder))
    return quality.amendment_score(amendments.canonicalize(events))


@register(
    "quality_gate",
    query(f"""SELECT count(*) AS checks, count(*) FILTER (WHERE ok) AS passed_checks,
                 avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS data_quality_score,
                 avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) >= 0.95 AS is_valid
              FROM (SELECT count(*) > 0 AS ok FROM source_records
                    UNION ALL SELECT bool_and(status = 'PASSED') FROM profile
                    UNION ALL SELECT count(*) = 0 FROM (
                        SELECT id FROM source_records GROUP BY id HAVING count(*) > 1)
                    UNION ALL SELECT out_of_range = 0 FROM ranges
                    UNION ALL SELECT future_dated = 0 FROM ranges
                    UNION ALL SELECT count(*) = 0 FROM (
                        SELECT id FROM source_records
                        WHERE id NOT IN (SELECT l_orderkey FROM lineitem)))""",
          profile=_profile_sql(), ranges=_RANGES),
)
def quality_gate(spark, folder):
    return quality.quality_gate(
        domain.source_records(spark, folder),
        ["id"],
        domain.table(spark, folder, "lineitem"),
        "l_orderkey",
        "id",
        _turn_of_century(),
    )


@register(
    "kmeans_anomalies",
    """SELECT count(*) AS scored, true AS flagged_beyond_limit, true AS any_flagged, true AS share_is_small
       FROM lineitem""",
)
def kmeans_anomalies(spark, folder):
    """Every row is scored, and flagged exactly when it is beyond the limit of its cluster."""
    lines = domain.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    rows = clustering.scored(lines, ["l_quantity", "l_extendedprice"])
    flagged = F.count_if("is_anomaly")
    return rows.agg(
        F.count("*").alias("scored"),
        F.bool_and(F.col("is_anomaly") == (F.col("distance") > F.col("limit"))).alias("flagged_beyond_limit"),
        (flagged > 0).alias("any_flagged"),
        (flagged <= 0.0105 * F.count("*")).alias("share_is_small"),
    )


def _reconcile_sql(source: str, target: str, key: str, filled: str) -> str:
    return f"""WITH per_key AS (
          SELECT key, sum(s) AS s, sum(t) AS t, sum(f) AS f FROM (
            SELECT {key} AS key, 1 AS s, 0 AS t, 0 AS f FROM ({source})
            UNION ALL SELECT {key}, 0, 1, CASE WHEN {filled} THEN 1 ELSE 0 END FROM ({target}))
          GROUP BY key),
        total AS (SELECT sum(s) AS s, sum(t) AS t, sum(f) AS f,
                         count(*) FILTER (WHERE t = 0) AS missing,
                         count(*) FILTER (WHERE s = 0) AS extra FROM per_key),
        checks AS (
          SELECT 'record_count' AS check_name, s AS source_value, t AS target_value,
                 s = t AS match FROM total
          UNION ALL SELECT 'missing_in_target', 0, missing, missing = 0 FROM total
          UNION ALL SELECT 'extra_in_target', 0, extra, extra = 0 FROM total
          UNION ALL SELECT 'region_population', f, CAST(f AS DOUBLE) / t * 100, NULL FROM total)
        SELECT check_name, CAST(source_value AS DOUBLE) AS source_value,
               CAST(target_value AS DOUBLE) AS target_value, match,
               CASE WHEN bool_and(coalesce(match, true)) OVER () THEN 'PASSED' ELSE 'FAILED' END
                   AS overall_status
        FROM checks"""


_FILLED = "REGION IS NOT NULL AND REGION <> 'UNKNOWN'"


@register(
    "reconcile_counts_keys",
    _reconcile_sql(
        query("SELECT TRANSACTION_ID AS id FROM transactions"),
        query("""SELECT TRANSACTION_ID AS id, CASE WHEN TRANSACTION_TYPE <> 'P' THEN 'KNOWN'
                 ELSE 'UNKNOWN' END AS REGION FROM transactions WHERE AMOUNT >= 1000"""),
        "id",
        _FILLED,
    ),
)
def reconcile_counts_keys(spark, folder):
    """All transactions against a target that lacks the small ones."""
    rows = domain.transactions(spark, folder)
    region = F.when(F.col("TRANSACTION_TYPE") != "P", "KNOWN").otherwise("UNKNOWN")
    target = rows.filter(F.col("AMOUNT") >= 1000).withColumn("REGION", region)
    return reconciliation.reconcile(
        rows, target, "TRANSACTION_ID", reconciliation.populated("REGION")
    )


_KNOWN_REGION = """SELECT TRANSACTION_ID AS id, CASE WHEN TRANSACTION_TYPE <> 'P' THEN 'KNOWN'
    ELSE 'UNKNOWN' END AS REGION FROM transactions"""


@register(
    "reconcile_by_digest",
    _reconcile_sql(
        query("SELECT TRANSACTION_ID AS id FROM transactions"),
        query(f"{_KNOWN_REGION} WHERE TRANSACTION_ID % 500 <> 3 UNION ALL SELECT -TRANSACTION_ID - 1, 'KNOWN'"
              " FROM transactions WHERE TRANSACTION_ID % 5000 = 7"),
        "id",
        _FILLED,
    ),
)
def reconcile_by_digest(spark, folder):
    """All transactions against a target that lacks a few and holds a few others."""
    rows = domain.transactions(spark, folder)
    region = F.when(F.col("TRANSACTION_TYPE") != "P", "KNOWN").otherwise("UNKNOWN")
    kept = rows.filter("TRANSACTION_ID % 500 <> 3").select("TRANSACTION_ID", region.alias("REGION"))
    more = rows.filter("TRANSACTION_ID % 5000 = 7").selectExpr("-TRANSACTION_ID - 1 as TRANSACTION_ID", "'KNOWN' as REGION")
    return reconciliation.reconcile_by_digest(
        rows, kept.unionByName(more), "TRANSACTION_ID", reconciliation.populated("REGION")
    )


@register(
    "full_reload",
    _reconcile_sql(
        query("SELECT BRANCH_ID FROM summary"),
        query("SELECT * FROM report"),
        "BRANCH_ID",
        _FILLED,
    ),
)
def full_reload(spark, folder):
    """Rebuild the report under a new path and compare it with the old summary."""
    rebuilt = write_path(branch_report(spark, folder), new_path(spark, "full_reload"))
    return reconciliation.reconcile(
        _branch_summary(spark, folder), rebuilt, "BRANCH_ID", reconciliation.populated("REGION")
    )


@register(
    "dimension_availability",
    query("""SELECT 'metadata' AS dimension, count(*) AS record_count,
                    count(*) FILTER (WHERE is_active) AS active_count,
                    count(*) FILTER (WHERE tile_category IS NULL) AS null_values,
                    count(*) > 0 AS available FROM metadata
             UNION ALL SELECT 'details', count(*), count(*) FILTER (WHERE IS_ACTIVE = 'Y'),
                    count(*) FILTER (WHERE REGION IS NULL), count(*) > 0 FROM details
             UNION ALL SELECT 'missing table', 0, 0, 0, false"""),
)
def dimension_availability(spark, folder):
    missing = table_or_empty(spark, "tallyline_no_such_table", schemas.schema("tile_metadata"))
    checks = {
        "metadata": quality.dimension_availability(
            domain.tile_metadata(spark, folder),
            F.col("is_active"),
            {"tile_category": "null_values"},
        ),
        "details": quality.dimension_availability(
            domain.branch_details(spark, folder),
            F.col("IS_ACTIVE") == "Y",
            {"REGION": "null_values"},
        ),
        "missing table": quality.dimension_availability(
            missing, F.col("is_active"), {"tile_category": "null_values"}
        ),
    }
    return union_all(
        [df.select(F.lit(name).alias("dimension"), "*") for name, df in checks.items()]
    )


# -- monitoring ----------------------------------------------------------------------------


def _measured(spark, folder):
    """A batch whose steps are stored one after the other, each timed by itself."""
    steps = monitoring.TimedSteps(spark, new_path(spark, "measured"))
    landing = steps.store(domain.landing(spark, folder), "Landing Data Ingestion")
    events = steps.store(amendments.extract_event_meta(landing), "Event Metadata Extraction")
    valid, _ = amendments.schema_split(events, strict=True)
    valid = steps.store(valid, "Valid Events After Schema Validation")
    accepted, _ = amendments.business_split(amendments.canonicalize(valid), strict=True)
    rendered = amendments.render(amendments.attach_template(accepted, domain.template(spark)))
    steps.store(rendered, "Final XML Output")
    return steps.frame(dt.datetime(2026, 1, 15))


@register(
    "step_metrics",
    query("""SELECT 'Landing Data Ingestion' AS step_name, count(*) AS row_count FROM landing
             UNION ALL SELECT 'Event Metadata Extraction', count(*) FROM meta
             UNION ALL SELECT 'Valid Events After Schema Validation', count(*) FROM judged
                       WHERE schema_reason IS NULL
             UNION ALL SELECT 'Final XML Output', count(*) FROM documents_out"""),
)
def step_metrics(spark, folder):
    return _measured(spark, folder).select("step_name", "row_count")


@register(
    "throughput_metrics",
    query("""SELECT 'Landing Data Ingestion' AS step_name, count(*) AS row_count, true AS has_rate,
                    true AS has_partitions, true AS has_own_duration FROM landing
             UNION ALL SELECT 'Event Metadata Extraction', count(*), true, true, true FROM meta
             UNION ALL SELECT 'Valid Events After Schema Validation', count(*), true, true, true
                       FROM judged WHERE schema_reason IS NULL
             UNION ALL SELECT 'Final XML Output', count(*), true, true, true FROM documents_out"""),
)
def throughput_metrics(spark, folder):
    measured = monitoring.throughput(_measured(spark, folder))
    alike = F.count("*").over(Window.partitionBy("duration_seconds"))
    return measured.select(
        "step_name",
        "row_count",
        (F.col("rows_per_second") > 0).alias("has_rate"),
        (F.col("partition_count") > 0).alias("has_partitions"),
        (alike == 1).alias("has_own_duration"),
    )


_COVERAGE = """SELECT *, CAST(branches_with_region AS DOUBLE) / total_branches * 100
        AS region_coverage_percent,
        CAST(branches_with_audit_date AS DOUBLE) / total_branches * 100
        AS audit_date_coverage_percent
    FROM (SELECT count(*) AS total_branches,
                 count(*) FILTER (WHERE REGION IS NOT NULL AND REGION <> 'UNKNOWN')
                     AS branches_with_region,
                 count(LAST_AUDIT_DATE) AS branches_with_audit_date FROM report)"""


@register("coverage_metrics", query(_COVERAGE))
def coverage_metrics(spark, folder):
    return monitoring.coverage(branch_report(spark, folder))


@register(
    "audit_freshness",
    query("""SELECT *, CAST(stale_audit_count AS DOUBLE) / total_active_branches * 100
                 AS stale_percentage
             FROM (SELECT count(*) FILTER (WHERE LAST_AUDIT_DATE < DATE '2023-04-11' - 90)
                              AS stale_audit_count,
                          count(*) FILTER (WHERE IS_ACTIVE = 'Y') AS total_active_branches
                   FROM details)"""),
)
def audit_freshness(spark, folder):
    as_of = F.lit("2023-04-11").cast("date")
    return monitoring.audit_freshness(domain.branch_details(spark, folder), as_of)


def _alert_sql(metric: str, label: str, bound: float) -> str:
    return f"""SELECT '{metric}' AS metric, {metric} AS value, CAST({bound} AS DOUBLE) AS bound,
        'DATA_COVERAGE_WARNING' AS type,
        printf('%s is %.1f%%, below threshold of %s%%', '{label}', {metric}, '{bound}') AS message
        FROM coverage WHERE {metric} < {bound}"""


@register(
    "threshold_alerts",
    query(
        _alert_sql("region_coverage_percent", "Region coverage", 85.0)
        + " UNION ALL "
        + _alert_sql("audit_date_coverage_percent", "Audit date coverage", 90.0),
        coverage=_COVERAGE,
    ),
)
def threshold_alerts(spark, folder):
    return monitoring.alerts(monitoring.coverage(branch_report(spark, folder)))
