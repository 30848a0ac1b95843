"""Filters, projections, expressions, order, layout and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions import cleansing, protection, text
from tallyline.functions.measures import safe_ratio
from tallyline.operators import clustering, layout, projections, sets
from tallyline.operators.windows import latest_per_key
from tallyline.plans import amendments, domain, engagement, regulatory
from tallyline.queries.registry import DAY, SQL_STAMP, register
from tallyline.queries.views import daily_summary, query
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path


def as_of():
    """Day of the fixed runs."""
    return F.lit("2026-01-15").cast("date")


def now():
    """Load time of the fixed runs."""
    return F.lit("2026-01-15 08:30:00").cast("timestamp_ntz")


_SUMMARY = """SELECT BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS, TOTAL_AMOUNT"""


def stamp(column: str) -> str:
    return f"strftime({column}, '{SQL_STAMP}')"


RECORD_COLUMNS = f"""id, column1, column2, CAST(column3 AS DOUBLE) AS column3, status,
    {stamp("created_date")} AS created_date, {stamp("updated_date")} AS updated_date,
    created_by, updated_by, data_classification"""


# -- filters and projections -----------------------------------------------------------


@register(
    "filter_process_date",
    query(f"""SELECT event_id, user_id, {stamp("event_ts")} AS event_ts, tile_id, event_type
              FROM tile_events WHERE CAST(event_ts AS DATE) = DATE '{DAY}'"""),
)
def filter_process_date(spark, folder):
    return projections.on_date(domain.tile_events(spark, folder), "event_ts", DAY)


@register(
    "filter_active_flag",
    query("""SELECT tile_id, tile_category AS label FROM metadata WHERE is_active
             UNION ALL SELECT CAST(BRANCH_ID AS VARCHAR), REGION FROM details
             WHERE IS_ACTIVE = 'Y'"""),
)
def filter_active_flag(spark, folder):
    tiles = projections.only_active(domain.tile_metadata(spark, folder), "is_active")
    details = projections.only_active(domain.branch_details(spark, folder), "IS_ACTIVE", "Y")
    return tiles.select("tile_id", F.col("tile_category").alias("label")).unionByName(
        details.select(
            F.col("BRANCH_ID").cast("string").alias("tile_id"), F.col("REGION").alias("label")
        )
    )


@register(
    "filter_status_in",
    query("SELECT id, status FROM source_records WHERE status IN ('ACTIVE', 'PENDING')"),
)
def filter_status_in(spark, folder):
    records = domain.source_records(spark, folder)
    return projections.status_in(records, ["ACTIVE", "PENDING"]).select("id", "status")


@register(
    "filter_having",
    query("""SELECT ACCOUNT_ID, count(*) AS TOTAL_TRANSACTIONS FROM transactions
             GROUP BY ACCOUNT_ID HAVING count(*) > 12"""),
)
def filter_having(spark, folder):
    counted = (
        domain.transactions(spark, folder)
        .groupBy("ACCOUNT_ID")
        .agg(F.count("*").alias("TOTAL_TRANSACTIONS"))
    )
    return projections.having(counted, "TOTAL_TRANSACTIONS", above=12)


@register(
    "project_constant",
    query(f"""SELECT event_id, '{DAY}' AS date, 'CORE' AS source_system, 'SCHEMA' AS reject_type
              FROM tile_events"""),
)
def project_constant(spark, folder):
    return projections.with_constants(
        domain.tile_events(spark, folder).select("event_id"),
        date=F.lit(DAY).cast("date"),
        source_system="CORE",
        reject_type="SCHEMA",
    )


@register(
    "project_default_zero",
    query("""SELECT c.ACCOUNT_ID, coalesce(n, 0) AS n FROM accounts c LEFT JOIN (
               SELECT ACCOUNT_ID, count(*) AS n FROM transactions
               WHERE TRANSACTION_TYPE = 'F' GROUP BY ACCOUNT_ID) t
             ON c.ACCOUNT_ID = t.ACCOUNT_ID"""),
)
def project_default_zero(spark, folder):
    finished = projections.status_in(
        domain.transactions(spark, folder), ["F"], "TRANSACTION_TYPE"
    )
    counts = finished.groupBy("ACCOUNT_ID").agg(F.count("*").alias("n"))
    joined = domain.accounts(spark, folder).select("ACCOUNT_ID").join(counts, "ACCOUNT_ID", "left")
    return projections.default_zero(joined, ["n"])


@register(
    "project_cast_target",
    query(f"""{_SUMMARY}, CAST(LAST_AUDIT_DATE AS VARCHAR) AS LAST_AUDIT_DATE FROM (
              SELECT CAST(s.BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
                     TOTAL_AMOUNT, LAST_AUDIT_DATE
              FROM summary s JOIN details d ON s.BRANCH_ID = d.BRANCH_ID)"""),
)
def project_cast_target(spark, folder):
    summary = _branch_summary(spark, folder)
    details = domain.branch_details(spark, folder).select("BRANCH_ID", "LAST_AUDIT_DATE")
    types = regulatory.REPORT_TYPES | {"LAST_AUDIT_DATE": "string"}
    return projections.cast_columns(summary.join(details, "BRANCH_ID"), types)


def _branch_summary(spark, folder):
    return regulatory.branch_summary(
        domain.transactions(spark, folder),
        domain.accounts(spark, folder),
        domain.branches(spark, folder),
    )


@register(
    "split_valid_reject",
    query("""SELECT event_id, kafka_offset,
                    CASE WHEN schema_reason IS NULL THEN 'valid' ELSE 'rejected' END AS side,
                    schema_reason AS reason
             FROM judged"""),
)
def split_valid_reject(spark, folder):
    events = amendments.extract_event_meta(domain.landing(spark, folder))
    valid, rejected = projections.split_by_reason(events, amendments.schema_reason())
    return valid.select(
        "event_id", "kafka_offset", F.lit("valid").alias("side"), F.lit(None).cast("string").alias("reason")
    ).unionByName(
        rejected.select(
            "event_id",
            "kafka_offset",
            F.lit("rejected").alias("side"),
            F.col("reject_reason").alias("reason"),
        )
    )


@register(
    "filter_row_security",
    query("""SELECT id, data_classification FROM source_records
             WHERE data_classification <> 'CONFIDENTIAL'"""),
)
def filter_row_security(spark, folder):
    records = domain.source_records(spark, folder).select("id", "data_classification")
    return projections.visible_rows(records, "RESTRICTED")


@register(
    "filter_retention",
    query("""SELECT id, CAST(CAST(created_date AS DATE) + 10500 AS VARCHAR) AS retention_date
             FROM source_records
             WHERE CAST(created_date AS DATE) + 10500 >= DATE '2026-01-15'"""),
)
def filter_retention(spark, folder):
    records = domain.source_records(spark, folder).select(
        "id",
        cleansing.retention_date(F.to_date("created_date"), days=10500).alias("retention_date"),
    )
    return projections.within_retention(records, as_of())


# -- text expressions ------------------------------------------------------------------


@register(
    "json_find_string",
    query("SELECT kafka_offset, event_id, loan_id, amendment_type FROM canonical"),
)
def json_find_string(spark, folder):
    keys = ["event_id", "loan_id", "amendment_type"]
    return domain.landing(spark, folder).select(
        "kafka_offset", *[text.json_string("payload_json", k).alias(k) for k in keys]
    )


@register(
    "json_find_scalar_strict",
    query(r"""SELECT kafka_offset, coalesce(regexp_extract(payload_json,
                '"new_rate"\s*:\s*([0-9.\-]+)', 1), '') AS new_rate FROM landing"""),
)
def json_find_scalar_strict(spark, folder):
    rate = text.json_number("payload_json", "new_rate", allow_quotes=False)
    return domain.landing(spark, folder).select("kafka_offset", rate.alias("new_rate"))


@register(
    "json_find_scalar",
    query("SELECT kafka_offset, prior_rate, new_rate, new_term_months FROM canonical"),
)
def json_find_scalar(spark, folder):
    keys = ["prior_rate", "new_rate", "new_term_months"]
    return domain.landing(spark, folder).select(
        "kafka_offset", *[text.json_number("payload_json", k).alias(k) for k in keys]
    )


_FILLED = """'<Amendment><LoanID>' || loan_id || '</LoanID><EventID>' || event_id
   || '</EventID><EffectiveDate>' || effective_date || '</EffectiveDate><Type>'
   || amendment_type || '</Type><NewRate>' || new_rate
   || '</NewRate><NewTermMonths>' || new_term_months || '</NewTermMonths></Amendment>'"""


def _canonical(spark, folder):
    meta = amendments.extract_event_meta(domain.landing(spark, folder))
    return amendments.canonicalize(meta)


@register(
    "render_template",
    query(f"SELECT kafka_offset, {_FILLED} AS xml_text FROM canonical"),
)
def render_template(spark, folder):
    filled = text.render_template(F.lit(domain.TEMPLATE_TEXT))
    return _canonical(spark, folder).select("kafka_offset", filled.alias("xml_text"))


@register(
    "xml_length",
    query(f"SELECT kafka_offset, length({_FILLED}) AS xml_length FROM canonical"),
)
def xml_length(spark, folder):
    filled = text.render_template(F.lit(domain.TEMPLATE_TEXT))
    return _canonical(spark, folder).select(
        "kafka_offset", text.text_length(filled).cast("bigint").alias("xml_length")
    )


@register(
    "parse_rate",
    query("""SELECT kafka_offset, TRY_CAST(new_rate AS DOUBLE) AS rate,
                    TRY_CAST(new_rate AS DOUBLE) IS NULL AS invalid FROM canonical"""),
)
def parse_rate(spark, folder):
    rate = text.parse_rate("new_rate")
    return _canonical(spark, folder).select(
        "kafka_offset", rate.alias("rate"), rate.isNull().alias("invalid")
    )


@register(
    "blank_check",
    query("""SELECT kafka_offset, trim(effective_date) = '' AS no_date,
                    payload_json IS NULL AS no_payload FROM canonical"""),
)
def blank_check(spark, folder):
    return _canonical(spark, folder).select(
        "kafka_offset",
        text.is_blank("effective_date").alias("no_date"),
        text.is_blank("payload_json").alias("no_payload"),
    )


# -- protection ------------------------------------------------------------------------


@register(
    "checksum_md5",
    query("""SELECT id,
               md5(concat_ws('|', CAST(id AS VARCHAR), column1, column2,
                             CAST(column3 AS VARCHAR))) AS checksum,
               md5(concat_ws('|', CAST(id AS VARCHAR), coalesce(column1, '~'),
                             coalesce(column2, '~'), coalesce(CAST(column3 AS VARCHAR), '~')))
                   AS checksum_with_nulls
             FROM source_records"""),
)
def checksum_md5(spark, folder):
    columns = ["id", "column1", "column2", "column3"]
    return domain.source_records(spark, folder).select(
        "id",
        protection.checksum_md5(columns).alias("checksum"),
        protection.checksum_md5(columns, null_token="~").alias("checksum_with_nulls"),
    )


@register("mask_hash", query("SELECT id, sha256(column2) AS column2 FROM source_records"))
def mask_hash(spark, folder):
    masked = protection.mask_hash("column2").alias("column2")
    return domain.source_records(spark, folder).select("id", masked)


_MASK_KEY = protection.MaskKey("k1", b"not a secret")
_PADS = [bytes(b ^ pad for b in _MASK_KEY.secret.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C)]


@register(
    "mask_hmac",
    query(f"""SELECT id, 'k1:' || sha256(unhex('{_PADS[1]}') || unhex(sha256(unhex('{_PADS[0]}') || encode(column2))))
                AS column2, column2 IS NOT NULL OR NULL AS matches FROM source_records"""),
)
def mask_hmac(spark, folder):
    masked = domain.source_records(spark, folder).select(
        "id", protection.mask_hmac("column2", _MASK_KEY).alias("masked"), "column2"
    )
    return masked.select(
        "id", F.col("masked").alias("column2"),
        protection.mask_matches("column2", "masked", [protection.MaskKey("k0", b"old"), _MASK_KEY]).alias("matches"),
    )


@register(
    "mask_partial",
    query("SELECT CUSTOMER_ID, substr(NAME, 1, 2) || '***' AS NAME FROM customers"),
)
def mask_partial(spark, folder):
    masked = protection.mask_partial("NAME").alias("NAME")
    return domain.customers(spark, folder).select("CUSTOMER_ID", masked)


@register(
    "mask_prefix4",
    query("SELECT CUSTOMER_ID, substr(NAME, 1, 4) || '****' AS NAME FROM customers"),
)
def mask_prefix4(spark, folder):
    masked = protection.mask_prefix4("NAME").alias("NAME")
    return domain.customers(spark, folder).select("CUSTOMER_ID", masked)


_KEY = "0123456789abcdef0123456789abcdef"


@register(
    "encrypt_columns",
    query("SELECT CUSTOMER_ID, NAME, true AS hidden FROM customers"),
)
def encrypt_columns(spark, folder):
    """Cipher texts differ from run to run, so they are shown to hide and give back the name."""
    from tallyline.operators.governance import encrypt_columns as encrypted

    key = F.lit(_KEY)
    rows = domain.customers(spark, folder).withColumn("clear", F.col("NAME"))
    rows = encrypted(rows, ["NAME"], key)
    return rows.select(
        "CUSTOMER_ID",
        protection.decrypt("NAME", key).alias("NAME"),
        (~F.contains("NAME", "clear")).alias("hidden"),
    )


# -- cleansing -------------------------------------------------------------------------


@register(
    "upper_trim_unknown",
    query("""SELECT id, coalesce(upper(trim(column2)), 'UNKNOWN') AS column2,
                    upper(column1) AS column1 FROM source_records"""),
)
def upper_trim_unknown(spark, folder):
    return domain.source_records(spark, folder).select(
        "id",
        cleansing.upper_trim("column2").alias("column2"),
        F.upper("column1").alias("column1"),
    )


@register(
    "bounded_round",
    query("""SELECT o_orderkey AS id, CAST(CASE WHEN amount BETWEEN 0 AND 999999.99
                    THEN round(amount, 2) END AS DOUBLE) AS amount
             FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) * 1.337 *
                          CASE WHEN o_orderkey % 9 = 4 THEN -1
                               WHEN o_orderkey % 13 = 6 THEN 10 ELSE 1 END AS amount
                   FROM orders)"""),
)
def bounded_round(spark, folder):
    key = F.col("o_orderkey")
    factor = F.when(key % 9 == 4, -1).when(key % 13 == 6, 10).otherwise(1)
    price = F.col("o_totalprice").cast("decimal(18,2)") * F.lit("1.337").cast("decimal(4,3)")
    rows = domain.table(spark, folder, "orders").select(
        key.alias("id"), (price * factor).alias("amount")
    )
    return rows.select("id", cleansing.bounded_round("amount").alias("amount"))


@register(
    "map_status",
    query("""SELECT id, CASE WHEN status = 'ACTIVE' THEN 'A' ELSE 'I' END AS two_way,
                    CASE status WHEN 'ACTIVE' THEN 'A' WHEN 'INACTIVE' THEN 'I'
                         WHEN 'PENDING' THEN 'P' ELSE 'U' END AS four_way
             FROM source_records"""),
)
def map_status(spark, folder):
    two_way = cleansing.map_status(
        "status", cleansing.STATUS_TWO_WAY, cleansing.STATUS_TWO_WAY_DEFAULT
    )
    return domain.source_records(spark, folder).select(
        "id", two_way.alias("two_way"), cleansing.map_status("status").alias("four_way")
    )


@register(
    "clean_region",
    query(r"""SELECT p_partkey, CASE WHEN length(region) = 0 THEN 'UNKNOWN'
                     WHEN regexp_matches(region, '^[A-Z\s]+$') THEN region
                     ELSE regexp_replace(region, '[^A-Z\s]', '', 'g') END AS region
              FROM (SELECT p_partkey, CASE WHEN p_size = 7 THEN '' WHEN p_size > 25 THEN p_type
                                           ELSE p_brand || ' ' || p_name || ' NORTH' END AS region
                    FROM part)"""),
)
def clean_region(spark, folder):
    size = F.col("p_size")
    region = (
        F.when(size == 7, F.lit(""))
        .when(size > 25, F.col("p_type"))
        .otherwise(F.concat_ws(" ", "p_brand", "p_name", F.lit("NORTH")))
    )
    return domain.table(spark, folder, "part").select(
        "p_partkey", cleansing.clean_region(region).alias("region")
    )


@register(
    "validate_iso_date_text",
    query(r"""SELECT o_orderkey, CASE WHEN regexp_matches(text, '^\d{4}-\d{2}-\d{2}$') THEN text END
                  AS audit_date
              FROM (SELECT o_orderkey, CASE o_orderstatus
                        WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                        WHEN 'F' THEN strftime(o_orderdate, '%d.%m.%Y') END AS text FROM orders)"""),
)
def validate_iso_date_text(spark, folder):
    status = F.col("o_orderstatus")
    shown = F.when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        status == "F", F.date_format("o_orderdate", "dd.MM.yyyy")
    )
    return domain.table(spark, folder, "orders").select(
        "o_orderkey", cleansing.iso_date_text(shown).alias("audit_date")
    )


@register(
    "retention_date",
    query("""SELECT TRANSACTION_ID,
               CAST(TRANSACTION_DATE + 2555 AS VARCHAR) AS by_days,
               CAST(CAST(TRANSACTION_DATE + INTERVAL 84 MONTH AS DATE) AS VARCHAR) AS by_months
             FROM transactions"""),
)
def retention_date(spark, folder):
    start = F.col("TRANSACTION_DATE")
    return domain.transactions(spark, folder).select(
        "TRANSACTION_ID",
        cleansing.retention_date(start).alias("by_days"),
        cleansing.retention_date(start, months=84).alias("by_months"),
    )


@register(
    "processing_timestamp",
    query("""SELECT id, '2026-01-15 08:30:00.000000' AS load_timestamp, true AS stamped
             FROM source_records"""),
)
def processing_timestamp(spark, folder):
    return domain.source_records(spark, folder).select(
        "id",
        cleansing.processing_timestamp(now()).alias("load_timestamp"),
        (cleansing.processing_timestamp() > F.col("created_date")).alias("stamped"),
    )


# -- ratios ----------------------------------------------------------------------------


@register(
    "safe_ratio",
    query(
        """SELECT tile_id, CASE WHEN unique_tile_views > 0
                  THEN CAST(unique_tile_clicks AS DOUBLE) / unique_tile_views ELSE 0.0 END AS ctr
           FROM day_summary""",
        day_summary=daily_summary(DAY),
    ),
)
def safe_ratio_query(spark, folder):
    summary = engagement.daily_summary(
        domain.tile_events(spark, folder), domain.interstitial_events(spark, folder), DAY
    )
    return summary.select(
        "tile_id", safe_ratio("unique_tile_clicks", "unique_tile_views").alias("ctr")
    )


# -- windows, order and layout -----------------------------------------------------------


@register(
    "latest_per_key",
    query(f"""SELECT tile_id, tile_name, tile_category, is_active, {stamp("updated_ts")} AS updated_ts
              FROM (SELECT *, row_number() OVER (PARTITION BY tile_id
                        ORDER BY updated_ts DESC, tile_category DESC) AS n
                    FROM metadata_history) WHERE n = 1"""),
)
def latest_per_key_query(spark, folder):
    history = domain.tile_metadata_history(spark, folder)
    return latest_per_key(history, ["tile_id"], ["updated_ts", "tile_category"])


_TRANSACTIONS = query("""SELECT TRANSACTION_ID, ACCOUNT_ID, TRANSACTION_TYPE,
    CAST(AMOUNT AS DOUBLE) AS AMOUNT, CAST(TRANSACTION_DATE AS VARCHAR) AS TRANSACTION_DATE
    FROM transactions""")


@register("order_by_keys", _TRANSACTIONS)
def order_by_keys(spark, folder):
    keys = [F.col("TRANSACTION_DATE").desc(), F.col("TRANSACTION_ID").asc()]
    return layout.order_by_keys(domain.transactions(spark, folder), keys)


@register("repartition_by_key", _TRANSACTIONS)
def repartition_by_key(spark, folder):
    return layout.partition_by_key(domain.transactions(spark, folder), ["ACCOUNT_ID"])


@register(
    "cluster_layout",
    query("""SELECT event_id, event_ts, loan_id, kafka_offset FROM meta"""),
)
def cluster_layout(spark, folder):
    events = amendments.extract_event_meta(domain.landing(spark, folder)).select(
        "event_id", "event_ts", "loan_id", "kafka_offset"
    )
    stored = write_path(events, new_path(spark, "cluster_input"))
    path = new_path(spark, "cluster_layout")
    return layout.clustered_rewrite(stored, path, ["loan_id", "event_ts", "kafka_offset"])


@register(
    "morton_layout",
    query("""SELECT event_id, event_ts, loan_id, kafka_offset FROM meta"""),
)
def morton_layout(spark, folder):
    events = amendments.extract_event_meta(domain.landing(spark, folder)).select(
        "event_id", "event_ts", "loan_id", "kafka_offset"
    )
    stored = write_path(events, new_path(spark, "morton_input"))
    return layout.morton_rewrite(stored, new_path(spark, "morton_layout"), ["loan_id", "event_ts"])


def _drawn_sql(turn: int) -> str:
    u = f"""(('0x' || substr(md5('7:{turn}|' || CAST(CAST(x AS DECIMAL(38,9)) AS VARCHAR) || '|'
        || CAST(CAST(y AS DECIMAL(38,9)) AS VARCHAR)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"""
    if not turn:
        return f"SELECT x, y FROM features ORDER BY {u}, x, y LIMIT 1"
    squares = [f"(SELECT pow(f.x - c.x, 2) + pow(f.y - c.y, 2) FROM c{k} c)" for k in range(turn)]
    nearest = f"least({', '.join(squares)})"
    return f"SELECT x, y FROM features f WHERE {nearest} > 0 ORDER BY -ln({u}) / {nearest}, x, y LIMIT 1"


@register(
    "kmeans_seeding",
    query(" UNION ALL ".join(f"SELECT {k} AS place, x AS BRANCH_ID, y AS TOTAL_TRANSACTIONS FROM c{k}" for k in range(3)),
          features="""SELECT CAST(BRANCH_ID AS DOUBLE) AS x, CAST(TOTAL_TRANSACTIONS AS DOUBLE) AS y FROM summary""",
          **{f"c{k}": _drawn_sql(k) for k in range(3)}),
)
def kmeans_seeding(spark, folder):
    """The rows that clustering starts from, whatever the layout."""
    columns = ["BRANCH_ID", "TOTAL_TRANSACTIONS"]
    rows = _branch_summary(spark, folder).repartition(5)
    centers = clustering.first_centers(rows, columns, 3, 7)
    return spark.createDataFrame(
        [(k, *c) for k, c in enumerate(centers)], "place int, BRANCH_ID double, TOTAL_TRANSACTIONS double"
    )


@register(
    "kmeans_partitioning",
    query("SELECT BRANCH_ID, TOTAL_TRANSACTIONS, true AS nearest, true AS in_range FROM summary"),
)
def kmeans_partitioning(spark, folder):
    """Branches by cluster; no centre may be closer to a branch than its own."""
    columns = ["BRANCH_ID", "TOTAL_TRANSACTIONS"]
    rows, centers = clustering.clustered(_branch_summary(spark, folder), columns, k=5, seed=1)
    laid_out = clustering.by_cluster(rows)
    own = clustering.distance_to_own(columns, centers)
    nearest = F.least(*[clustering.distance(columns, center) for center in centers])
    return laid_out.select(
        *columns,
        (own <= nearest * (1 + 1e-9)).alias("nearest"),
        F.col("prediction").between(0, len(centers) - 1).alias("in_range"),
    )


# -- set operations ------------------------------------------------------------------------


@register("union_rejects", query("SELECT * FROM rejects"))
def union_rejects(spark, folder):
    """Rejects of both kinds from one judgement of each row."""
    events = amendments.extract_event_meta(domain.landing(spark, folder))
    assessed = amendments.assess(events, domain.template(spark))
    return amendments.rejects_of(assessed).drop("processing_ts")


@register(
    "union_increment",
    query("""SELECT kafka_offset, ingest_ts, payload_json FROM landing
             UNION ALL SELECT kafka_offset, ingest_ts, payload_json FROM resent"""),
)
def union_increment(spark, folder):
    rows = sets.union_all([domain.landing(spark, folder), domain.resent(spark, folder)])
    return rows.select("kafka_offset", "ingest_ts", "payload_json")


@register("distinct_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, folder):
    return sets.distinct_keys(
        domain.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


_LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


@register(
    "drop_duplicates_by_key",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               {stamp("l_shipdate")} AS l_shipdate
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY {", ".join(f"{c} DESC" for c in _LINE_ORDER)}) AS n FROM lineitem)
        WHERE n = 1""",
)
def drop_duplicates_by_key(spark, folder):
    lines = domain.table(spark, folder, "lineitem")
    return sets.drop_duplicates(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
