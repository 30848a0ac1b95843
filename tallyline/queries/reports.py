"""Joins, aggregations and the two report families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators.projections import with_constants
from tallyline.operators import joins, quality
from tallyline.operators.windows import latest_per_key
from tallyline.plans import amendments, domain, engagement, regulatory
from tallyline.queries.basics import _branch_summary
from tallyline.queries.registry import DAY, register
from tallyline.queries.views import daily_summary, interstitial_counts, query, tile_counts
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path

_MEASURES = """unique_tile_views, unique_tile_clicks, unique_interstitial_views,
    unique_interstitial_primary_clicks, unique_interstitial_secondary_clicks"""
_DAY = {
    "day_summary": daily_summary(DAY),
    "enriched": f"""SELECT date, s.tile_id, coalesce(m.tile_category, 'UNKNOWN') AS tile_category,
        {_MEASURES} FROM day_summary s LEFT JOIN current_metadata m ON s.tile_id = m.tile_id""",
}
_REPORT = "BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT, REGION, LAST_AUDIT_DATE"


def regulatory_tables(spark, folder):
    return (
        domain.transactions(spark, folder),
        domain.accounts(spark, folder),
        domain.branches(spark, folder),
    )


def branch_report(spark, folder, policy="active_null"):
    details = domain.branch_details(spark, folder)
    return regulatory.branch_summary_report(*regulatory_tables(spark, folder), details, policy)


def day_summary(spark, folder, day=DAY):
    tiles = domain.tile_events(spark, folder)
    return engagement.daily_summary(tiles, domain.interstitial_events(spark, folder), day)


def enriched_summary(spark, folder, day=DAY):
    metadata = domain.tile_metadata_history(spark, folder)
    return engagement.with_category(day_summary(spark, folder, day), metadata)


# -- customer transactions -------------------------------------------------------------

_AML = query("""
    SELECT c.CUSTOMER_ID, NAME, x.ACCOUNT_ID, TRANSACTION_ID, CAST(AMOUNT AS DOUBLE) AS AMOUNT,
           TRANSACTION_TYPE, CAST(TRANSACTION_DATE AS VARCHAR) AS TRANSACTION_DATE
    FROM transactions x JOIN accounts a ON x.ACCOUNT_ID = a.ACCOUNT_ID
    JOIN customers c ON a.CUSTOMER_ID = c.CUSTOMER_ID""")


@register("aml_customer_transactions", _AML)
def aml_customer_transactions(spark, folder):
    return regulatory.customer_transactions(
        domain.customers(spark, folder),
        domain.accounts(spark, folder),
        domain.transactions(spark, folder),
    )


@register("aml_customer_transactions_ordered", _AML)
def aml_customer_transactions_ordered(spark, folder):
    return regulatory.customer_transactions_ordered(
        domain.customers(spark, folder),
        domain.accounts(spark, folder),
        domain.transactions(spark, folder),
    )


# -- branch summary ----------------------------------------------------------------------


@register("branch_ops_active_null", query(f"SELECT {_REPORT} FROM report"))
def branch_ops_active_null(spark, folder):
    return branch_report(spark, folder)


@register(
    "branch_ops_active_unknown",
    query("""SELECT CAST(s.BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
                    TOTAL_AMOUNT, coalesce(REGION, 'UNKNOWN') AS REGION,
                    CAST(LAST_AUDIT_DATE AS VARCHAR) AS LAST_AUDIT_DATE
             FROM summary s LEFT JOIN active_details d ON s.BRANCH_ID = d.BRANCH_ID""",
          active_details="SELECT * FROM details WHERE IS_ACTIVE = 'Y'"),
)
def branch_ops_active_unknown(spark, folder):
    return branch_report(spark, folder, "active_unknown")


@register("branch_ops_all_sentinel", query(f"SELECT {_REPORT} FROM sentinel_report"))
def branch_ops_all_sentinel(spark, folder):
    return branch_report(spark, folder, "all_sentinel")


@register(
    "branch_ops_inner",
    query(f"""SELECT {_REPORT} FROM report WHERE BRANCH_ID IN (SELECT BRANCH_ID FROM details)"""),
)
def branch_ops_inner(spark, folder):
    return branch_report(spark, folder, "active_inner")


@register(
    "branch_summary",
    query("SELECT BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT FROM summary"),
)
def branch_summary(spark, folder):
    return _branch_summary(spark, folder)


@register("branch_summary_enhanced", query(f"SELECT {_REPORT} FROM report"))
def branch_summary_enhanced(spark, folder):
    latest = latest_per_key(
        domain.branch_details(spark, folder), ["BRANCH_ID"], ["LAST_AUDIT_DATE", "MANAGER_NAME"]
    )
    return regulatory.branch_summary_report(*regulatory_tables(spark, folder), latest)


@register(
    "branch_business_rules",
    query("""SELECT s.BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT,
                    CASE WHEN IS_ACTIVE = 'Y' THEN coalesce(upper(trim(REGION)), 'UNKNOWN')
                         ELSE 'INACTIVE' END AS REGION,
                    CASE WHEN IS_ACTIVE = 'Y' THEN CAST(LAST_AUDIT_DATE AS VARCHAR) END
                        AS LAST_AUDIT_DATE
             FROM summary s LEFT JOIN details d ON s.BRANCH_ID = d.BRANCH_ID"""),
)
def branch_business_rules(spark, folder):
    summary = _branch_summary(spark, folder)
    joined = summary.join(domain.branch_details(spark, folder), "BRANCH_ID", "left")
    return regulatory.branch_business_rules(joined)


@register(
    "region_totals",
    query("""SELECT REGION, count(*) AS branch_count,
                    CAST(sum(CAST(TOTAL_AMOUNT AS DECIMAL(25,2))) AS DOUBLE)
                        AS total_regional_amount
             FROM report WHERE REGION IS NOT NULL GROUP BY REGION"""),
)
def region_totals(spark, folder):
    return regulatory.region_totals(branch_report(spark, folder))


@register(
    "audit_coverage",
    query("""SELECT REGION, count(*) AS total_branches,
                    count(CASE WHEN LAST_AUDIT_DATE <> 'NOT_AVAILABLE' THEN 1 END)
                        AS audited_branches,
                    CAST(round(count(CASE WHEN LAST_AUDIT_DATE <> 'NOT_AVAILABLE' THEN 1 END)
                         * 100.0 / count(*), 2) AS DOUBLE) AS audit_coverage_pct
             FROM sentinel_report GROUP BY REGION"""),
)
def audit_coverage(spark, folder):
    return regulatory.audit_coverage(branch_report(spark, folder, "all_sentinel"))


# -- dimension joins and key comparisons ---------------------------------------------------


@register(
    "unmatched_keys",
    query("""SELECT 'events of tiles without metadata' AS finding, count(*) AS unmatched_rows
             FROM tile_events t LEFT JOIN (SELECT DISTINCT tile_id FROM metadata) m
             ON t.tile_id = m.tile_id WHERE m.tile_id IS NULL
             UNION ALL SELECT 'branches without details', count(*)
             FROM branches b LEFT JOIN details d ON b.BRANCH_ID = d.BRANCH_ID
             WHERE d.BRANCH_ID IS NULL"""),
)
def unmatched_keys(spark, folder):
    tiles = joins.unmatched_count(
        domain.tile_events(spark, folder), domain.tile_metadata(spark, folder), "tile_id"
    )
    branches = joins.unmatched_count(
        domain.branches(spark, folder), domain.branch_details(spark, folder), "BRANCH_ID"
    )
    return tiles.select(
        F.lit("events of tiles without metadata").alias("finding"), "unmatched_rows"
    ).unionByName(
        branches.select(F.lit("branches without details").alias("finding"), "unmatched_rows")
    )


@register(
    "template_cross_join",
    query(f"""SELECT kafka_offset, event_id, '{domain.TEMPLATE_KEY}' AS template_key,
                     '{domain.TEMPLATE_TEXT}' AS template_text FROM meta"""),
)
def template_cross_join(spark, folder):
    events = amendments.extract_event_meta(domain.landing(spark, folder)).select(
        "kafka_offset", "event_id"
    )
    return amendments.attach_template(events, domain.template(spark))


@register(
    "key_reconcile",
    """SELECT coalesce(o, l) AS order_key,
              CASE WHEN l IS NULL THEN 'missing_in_target' ELSE 'extra_in_target' END AS finding
       FROM (SELECT DISTINCT o_orderkey + 100 AS o FROM orders) a
       FULL JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) b ON o = l
       WHERE o IS NULL OR l IS NULL""",
)
def key_reconcile(spark, folder):
    """Shifted order keys against the order keys of the lines."""
    orders = domain.table(spark, folder, "orders")
    lines = domain.table(spark, folder, "lineitem")
    return joins.key_reconcile(
        orders.select((F.col("o_orderkey") + 100).alias("order_key")),
        lines.select(F.col("l_orderkey").alias("order_key")),
        "order_key",
    )


@register(
    "referential_integrity",
    query("""SELECT count(DISTINCT t.tile_id) AS orphan_keys, count(*) AS orphan_rows
             FROM interstitial_events t LEFT JOIN (SELECT DISTINCT tile_id FROM metadata) m
             ON t.tile_id = m.tile_id WHERE t.tile_id IS NOT NULL AND m.tile_id IS NULL"""),
)
def referential_integrity(spark, folder):
    return joins.referential_integrity(
        domain.interstitial_events(spark, folder),
        domain.tile_metadata(spark, folder),
        "tile_id",
        "tile_id",
    )


@register(
    "safe_dimension_join",
    query("""SELECT s.BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT, REGION,
                    MANAGER_NAME, CAST(LAST_AUDIT_DATE AS VARCHAR) AS LAST_AUDIT_DATE, IS_ACTIVE
             FROM summary s LEFT JOIN (
                SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY BRANCH_ID
                    ORDER BY LAST_AUDIT_DATE DESC NULLS LAST, MANAGER_NAME DESC) AS n
                    FROM details_history) WHERE n = 1) d
             ON s.BRANCH_ID = d.BRANCH_ID"""),
)
def safe_dimension_join(spark, folder):
    base = write_path(_branch_summary(spark, folder), new_path(spark, "branch_summary"))
    return joins.safe_dimension_join(
        base,
        domain.branch_details_history(spark, folder),
        "BRANCH_ID",
        ["LAST_AUDIT_DATE", "MANAGER_NAME"],
    )


@register(
    "scalar_lookup_backfill",
    query("""SELECT t.event_id, t.tile_id, coalesce(m.tile_category, 'UNKNOWN') AS tile_category
             FROM tile_events t LEFT JOIN metadata m ON t.tile_id = m.tile_id"""),
)
def scalar_lookup_backfill(spark, folder):
    events = domain.tile_events(spark, folder).select(
        "event_id", "tile_id", F.lit(None).cast("string").alias("tile_category")
    )
    return joins.scalar_backfill(
        events, domain.tile_metadata(spark, folder), "tile_id", {"tile_category": "UNKNOWN"}
    )


# -- engagement ----------------------------------------------------------------------------


@register("tile_daily_counts", query(tile_counts(DAY)))
def tile_daily_counts(spark, folder):
    from tallyline.operators.projections import on_date

    return engagement.tile_counts(on_date(domain.tile_events(spark, folder), "event_ts", DAY))


@register("interstitial_daily_counts", query(interstitial_counts(DAY)))
def interstitial_daily_counts(spark, folder):
    from tallyline.operators.projections import on_date

    events = on_date(domain.interstitial_events(spark, folder), "event_ts", DAY)
    return engagement.interstitial_counts(events)


_ALL_TILES = tile_counts(DAY).replace(f"WHERE CAST(event_ts AS DATE) = DATE '{DAY}'", "")
_ALL_INTERSTITIALS = interstitial_counts(DAY).replace(
    f"WHERE CAST(event_ts AS DATE) = DATE '{DAY}'", ""
)


@register(
    "tile_daily_full_outer",
    query(f"""SELECT coalesce(t.tile_id, i.tile_id) AS tile_id, {_MEASURES}
              FROM all_tiles t FULL JOIN all_interstitials i ON t.tile_id = i.tile_id""",
          all_tiles=_ALL_TILES, all_interstitials=_ALL_INTERSTITIALS),
)
def tile_daily_full_outer(spark, folder):
    """Counts over all days, so that the join is seen on the whole tables."""
    return engagement.combined_counts(
        engagement.tile_counts(domain.tile_events(spark, folder)),
        engagement.interstitial_counts(domain.interstitial_events(spark, folder)),
    )


_DATED = "CAST(date AS VARCHAR) AS date"


@register(
    "tile_daily_summary", query(f"SELECT {_DATED}, tile_id, {_MEASURES} FROM day_summary", **_DAY)
)
def tile_daily_summary(spark, folder):
    return day_summary(spark, folder)


_ENRICHED = query(f"SELECT {_DATED}, tile_id, tile_category, {_MEASURES} FROM enriched", **_DAY)


@register(
    "tile_category_enrich",
    query(f"""SELECT 'all' AS date, coalesce(t.tile_id, i.tile_id) AS tile_id,
                     coalesce(m.tile_category, 'UNKNOWN') AS tile_category, {_MEASURES}
              FROM all_tiles t FULL JOIN all_interstitials i ON t.tile_id = i.tile_id
              LEFT JOIN current_metadata m ON m.tile_id = coalesce(t.tile_id, i.tile_id)""",
          all_tiles=_ALL_TILES, all_interstitials=_ALL_INTERSTITIALS),
)
def tile_category_enrich(spark, folder):
    """Tiles of all days; the metadata has several versions per tile, and inactive ones."""
    counts = engagement.combined_counts(
        engagement.tile_counts(domain.tile_events(spark, folder)),
        engagement.interstitial_counts(domain.interstitial_events(spark, folder)),
    )
    dated = with_constants(counts, date="all").select("date", *counts.columns)
    return engagement.with_category(dated, domain.tile_metadata_history(spark, folder))


@register("tile_daily_summary_enriched", _ENRICHED)
def tile_daily_summary_enriched(spark, folder):
    return enriched_summary(spark, folder)


_TOTALS = """CAST(sum(unique_tile_views) AS BIGINT) AS total_tile_views,
    CAST(sum(unique_tile_clicks) AS BIGINT) AS total_tile_clicks,
    CAST(sum(unique_interstitial_views) AS BIGINT) AS total_interstitial_views,
    CAST(sum(unique_interstitial_primary_clicks) AS BIGINT) AS total_primary_clicks,
    CAST(sum(unique_interstitial_secondary_clicks) AS BIGINT) AS total_secondary_clicks"""


def _rate(name: str, top: str, bottom: str) -> str:
    return (
        f"CASE WHEN {bottom} > 0 THEN CAST({top} AS DOUBLE) / {bottom} ELSE 0.0 END AS {name}"
    )


_RATES = ", ".join(
    [
        _rate("overall_ctr", "total_tile_clicks", "total_tile_views"),
        _rate("overall_primary_ctr", "total_primary_clicks", "total_interstitial_views"),
        _rate("overall_secondary_ctr", "total_secondary_clicks", "total_interstitial_views"),
    ]
)


@register(
    "tile_global_kpis",
    query(f"""SELECT *, {_RATES} FROM (
              SELECT {_DATED}, {_TOTALS} FROM day_summary GROUP BY day_summary.date)""", **_DAY),
)
def tile_global_kpis(spark, folder):
    return engagement.global_kpis(day_summary(spark, folder))


@register(
    "tile_category_rollup",
    query(f"""SELECT *, {_RATES} FROM (SELECT tile_category, count(*) AS tile_count, {_TOTALS}
              FROM enriched GROUP BY tile_category)""", **_DAY),
)
def tile_category_rollup(spark, folder):
    return engagement.category_rollup(enriched_summary(spark, folder))


@register(
    "category_distribution",
    query("""SELECT tile_category, count(*) AS tile_count FROM enriched
             GROUP BY tile_category""", **_DAY),
)
def category_distribution(spark, folder):
    from tallyline.operators.sets import union_all

    days = [enriched_summary(spark, folder, day) for day in ("2024-01-04", DAY)]
    return engagement.category_distribution(union_all(days), DAY)


@register(
    "null_counts",
    query("""SELECT count(*) FILTER (WHERE id IS NULL) AS id, count(*) FILTER (WHERE column2 IS NULL) AS column2,
                    count(*) FILTER (WHERE updated_date IS NULL) AS updated_date,
                    count(*) FILTER (WHERE data_classification IS NULL) AS data_classification
             FROM source_records"""),
)
def null_counts(spark, folder):
    columns = ["id", "column2", "updated_date", "data_classification"]
    return quality.null_counts(domain.source_records(spark, folder), columns)


# -- the jobs as a whole ---------------------------------------------------------------------


_JOB_ROWS = query(f"""SELECT {_REPORT}, CAST(NULL AS BIGINT) AS TRANSACTION_ID FROM report
              UNION ALL SELECT a.BRANCH_ID, NAME, NULL, CAST(AMOUNT AS DOUBLE), TRANSACTION_TYPE,
                     CAST(TRANSACTION_DATE AS VARCHAR), TRANSACTION_ID
              FROM transactions x JOIN accounts a ON x.ACCOUNT_ID = a.ACCOUNT_ID
              JOIN customers c ON a.CUSTOMER_ID = c.CUSTOMER_ID""")


def _job_rows(spark, folder, job):
    """Both reports that a job wrote, in one frame."""
    transactions, accounts, branches = regulatory_tables(spark, folder)
    written = job(
        domain.customers(spark, folder),
        accounts,
        transactions,
        branches,
        domain.branch_details(spark, folder),
        new_path(spark, "regulatory"),
    )
    rows = written.customer_transactions.join(
        accounts.select("ACCOUNT_ID", "BRANCH_ID"), "ACCOUNT_ID"
    ).select(
        F.col("BRANCH_ID").cast("bigint").alias("BRANCH_ID"),
        F.col("NAME").alias("BRANCH_NAME"),
        F.lit(None).cast("bigint").alias("TOTAL_TRANSACTIONS"),
        F.col("AMOUNT").cast("double").alias("TOTAL_AMOUNT"),
        F.col("TRANSACTION_TYPE").alias("REGION"),
        F.col("TRANSACTION_DATE").cast("string").alias("LAST_AUDIT_DATE"),
        "TRANSACTION_ID",
    )
    report = written.branch_summary.withColumn("TRANSACTION_ID", F.lit(None).cast("bigint"))
    return report.unionByName(rows)


@register("regulatory_job", _JOB_ROWS)
def regulatory_job(spark, folder):
    """Both reports of the job, written, checked and read back."""
    return _job_rows(spark, folder, regulatory.run_reports)


@register("regulatory_release", _JOB_ROWS)
def regulatory_release(spark, folder):
    """The same reports, written once and published together, by a second run."""

    def twice(*tables):
        regulatory.release_reports(*tables)
        return regulatory.release_reports(*tables)

    return _job_rows(spark, folder, twice)


@register(
    "engagement_job",
    query(f"""SELECT {_DATED}, tile_category, CAST(sum(unique_tile_views) AS BIGINT)
                     AS unique_tile_views, total_tile_views, overall_ctr
              FROM enriched JOIN (SELECT *, {_RATES} FROM (SELECT {_TOTALS} FROM day_summary))
              ON true GROUP BY enriched.date, tile_category, total_tile_views, overall_ctr""",
          **_DAY),
)
def engagement_job(spark, folder):
    """One day of both reports, written and read back: categories beside the totals."""
    written = engagement.run_day(
        domain.tile_events(spark, folder),
        domain.interstitial_events(spark, folder),
        new_path(spark, "engagement"),
        DAY,
        domain.tile_metadata_history(spark, folder),
    )
    categories = written.daily.groupBy("date", "tile_category").agg(
        F.sum("unique_tile_views").alias("unique_tile_views")
    )
    kpis = written.kpis.select("date", "total_tile_views", "overall_ctr")
    return categories.join(kpis, "date")
