"""The domain views in SQL, written independently of the DataFrame versions."""

from __future__ import annotations

import re

VIEWS = {
    "customers": "SELECT c_custkey AS CUSTOMER_ID, c_name AS NAME FROM customer",
    "accounts": """
        SELECT c_custkey AS ACCOUNT_ID, c_custkey AS CUSTOMER_ID, c_nationkey AS BRANCH_ID,
               c_mktsegment AS ACCOUNT_TYPE, CAST(c_acctbal AS DECIMAL(15,2)) AS BALANCE
        FROM customer""",
    "transactions": """
        SELECT o_orderkey AS TRANSACTION_ID, o_custkey AS ACCOUNT_ID,
               o_orderstatus AS TRANSACTION_TYPE, CAST(o_totalprice AS DECIMAL(15,2)) AS AMOUNT,
               CAST(o_orderdate AS DATE) AS TRANSACTION_DATE
        FROM orders""",
    "branches": "SELECT n_nationkey AS BRANCH_ID, n_name AS BRANCH_NAME FROM nation",
    "details": """
        SELECT n_nationkey AS BRANCH_ID,
               CASE WHEN n_nationkey % 11 <> 5 THEN r_name END AS REGION,
               'Manager ' || n_name AS MANAGER_NAME,
               CASE WHEN n_nationkey % 7 <> 2
                    THEN CAST(DATE '2023-01-01' + n_nationkey AS DATE) END AS LAST_AUDIT_DATE,
               CASE WHEN n_nationkey % 3 = 0 THEN 'N' ELSE 'Y' END AS IS_ACTIVE
        FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE r_name <> 'MIDDLE EAST'""",
    "details_history": """
        SELECT * FROM details
        UNION ALL
        SELECT BRANCH_ID, REGION, 'Deputy ' || MANAGER_NAME,
               CAST(LAST_AUDIT_DATE + INTERVAL 1 MONTH AS DATE), IS_ACTIVE
        FROM details""",
    "numbered_events": r"""
        SELECT *, CAST(regexp_extract(props, '"k"\s*:\s*"?([0-9.\-]+)', 1) AS INTEGER) AS k
        FROM events""",
    "tile_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               ts AS event_ts, CASE WHEN k <> 13 THEN 'TILE_' || k END AS tile_id,
               CASE event_type WHEN 'view' THEN 'TILE_VIEW' WHEN 'click' THEN 'TILE_CLICK'
                    ELSE upper(event_type) END AS event_type
        FROM numbered_events""",
    "interstitial_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               ts AS event_ts, CASE WHEN k <> 13 THEN 'TILE_' || (k + 20) END AS tile_id,
               CASE WHEN event_type <> 'view' THEN event_type = 'signup' END
                   AS interstitial_view_flag,
               event_type = 'purchase' AS primary_button_click_flag,
               event_type = 'error' AS secondary_button_click_flag
        FROM numbered_events""",
    "metadata": """
        SELECT 'TILE_' || (p_partkey + 40) AS tile_id, p_name AS tile_name,
               p_type AS tile_category, p_size % 2 = 0 AS is_active,
               CAST(DATE '2023-06-01' + p_size AS TIMESTAMP) AS updated_ts
        FROM part""",
    "metadata_history": """
        SELECT * FROM metadata
        UNION ALL
        SELECT tile_id, tile_name, 'LEGACY', is_active, updated_ts - INTERVAL 30 DAY
        FROM metadata""",
    "current_metadata": """
        SELECT tile_id, tile_category FROM (
            SELECT tile_id, tile_category, row_number() OVER (
                PARTITION BY tile_id ORDER BY updated_ts DESC, tile_category DESC) AS n
            FROM metadata_history WHERE is_active)
        WHERE n = 1""",
    "summary": """
        SELECT t.BRANCH_ID, b.BRANCH_NAME, count(*) AS TOTAL_TRANSACTIONS,
               CAST(sum(x.AMOUNT) AS DOUBLE) AS TOTAL_AMOUNT
        FROM transactions x JOIN accounts t ON x.ACCOUNT_ID = t.ACCOUNT_ID
        JOIN branches b ON t.BRANCH_ID = b.BRANCH_ID
        GROUP BY t.BRANCH_ID, b.BRANCH_NAME""",
    "report": """
        SELECT CAST(s.BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
               TOTAL_AMOUNT, CASE WHEN IS_ACTIVE = 'Y' THEN REGION END AS REGION,
               CASE WHEN IS_ACTIVE = 'Y' THEN CAST(LAST_AUDIT_DATE AS VARCHAR) END
                   AS LAST_AUDIT_DATE
        FROM summary s LEFT JOIN details d ON s.BRANCH_ID = d.BRANCH_ID""",
    "sentinel_report": """
        SELECT CAST(s.BRANCH_ID AS BIGINT) AS BRANCH_ID, BRANCH_NAME, TOTAL_TRANSACTIONS,
               TOTAL_AMOUNT, coalesce(REGION, 'UNKNOWN') AS REGION,
               coalesce(CAST(LAST_AUDIT_DATE AS VARCHAR), 'NOT_AVAILABLE') AS LAST_AUDIT_DATE
        FROM summary s LEFT JOIN details d ON s.BRANCH_ID = d.BRANCH_ID""",
    "landing_parts": r"""
        SELECT event_id, user_id, ts, event_type, event_id % 12 AS slot,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
               CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS rate
        FROM events""",
    "landing": r"""
        SELECT 'key' || user_id AS kafka_key, CAST(event_id % 4 AS INTEGER) AS kafka_partition,
               event_id AS kafka_offset, stamp AS ingest_ts,
               CASE WHEN slot <> 3 THEN
                 '{"event_id":"' || CASE WHEN slot = 0 THEN '' ELSE 'evt' || event_id END
                 || '","event_type":"'
                 || CASE WHEN slot = 2 THEN 'OTHER_EVENT' ELSE 'MORTGAGE_AMENDMENT' END
                 || '","event_ts":"' || stamp
                 || '", "loan_id" : "' || CASE WHEN slot = 1 THEN '' ELSE 'loan' || user_id END
                 || '","source_system":"CORE","amendment_type":"'
                 || CASE WHEN slot = 6 THEN ''
                         WHEN event_type IN ('signup', 'purchase', 'error') THEN 'RATE_CHANGE'
                         ELSE 'TERM_CHANGE' END
                 || '","effective_date":"'
                 || CASE slot WHEN 4 THEN '' WHEN 5 THEN '  '
                         ELSE strftime(ts, '%Y-%m-%d') END
                 || '","prior_rate":3.75,"new_rate":'
                 || CASE WHEN slot = 7 THEN '""' WHEN slot = 8 THEN '"1.2.3"'
                         WHEN slot = 9 THEN '-1'
                         WHEN event_type = 'error' THEN '"' || rate || '"' ELSE rate END
                 || ',"prior_term_months":"360","new_term_months":'
                 || CASE WHEN slot = 10 THEN '""'
                         ELSE CAST(user_id % 30 * 12 + 12 AS VARCHAR) END
                 || '}' END AS payload_json
        FROM landing_parts""",
    "resent": """
        SELECT kafka_key, kafka_partition, kafka_offset + 1000000000 AS kafka_offset,
               '2024-02-01T00:00:00Z' AS ingest_ts,
               replace(payload_json, '"prior_rate":3.75', '"prior_rate":3.25') AS payload_json
        FROM landing WHERE payload_json LIKE '%RATE_CHANGE%'""",
    "meta": "SELECT {header}, * FROM landing",
    "canonical": "SELECT *, {fields} FROM meta",
    "judged": """
        SELECT *, CASE WHEN event_id = '' THEN 'Missing event_id'
                       WHEN loan_id = '' THEN 'Missing loan_id'
                       WHEN event_type <> 'MORTGAGE_AMENDMENT' THEN 'Unexpected event_type'
                  END AS schema_reason
        FROM canonical""",
    "basic_reasons": """
        SELECT *, CASE WHEN schema_reason IS NOT NULL THEN NULL
                       WHEN effective_date = '' THEN 'Missing effective_date'
                       WHEN amendment_type = '' THEN 'Missing amendment_type'
                       WHEN amendment_type = 'RATE_CHANGE' AND new_rate = ''
                            THEN 'Missing new_rate for RATE_CHANGE'
                  END AS business_reason
        FROM judged""",
    "strict_reasons": """
        SELECT *, CASE WHEN schema_reason IS NOT NULL THEN NULL
                       WHEN trim(effective_date) = '' THEN 'Missing effective_date'
                       WHEN trim(amendment_type) = '' THEN 'Missing amendment_type'
                       WHEN amendment_type = 'RATE_CHANGE' AND trim(new_rate) = ''
                            THEN 'Missing new_rate for RATE_CHANGE'
                       WHEN amendment_type = 'TERM_CHANGE' AND trim(new_term_months) = ''
                            THEN 'Missing new_term_months for TERM_CHANGE'
                       WHEN amendment_type = 'RATE_CHANGE'
                            AND TRY_CAST(new_rate AS DOUBLE) IS NULL THEN 'Invalid rate format'
                       WHEN amendment_type = 'RATE_CHANGE'
                            AND NOT TRY_CAST(new_rate AS DOUBLE) BETWEEN 0 AND 50
                            THEN 'Invalid rate range (must be 0-50%)'
                  END AS business_reason
        FROM judged""",
    "outcomes": """
        SELECT *, CASE WHEN schema_reason IS NOT NULL THEN 'SCHEMA'
                       WHEN business_reason IS NOT NULL THEN 'BUSINESS'
                       ELSE 'RENDERED' END AS outcome
        FROM strict_reasons""",
    "rejects": """
        SELECT outcome AS reject_type, coalesce(schema_reason, business_reason) AS reason,
               event_id, loan_id, event_ts, source_system, kafka_partition, kafka_offset,
               ingest_ts, CASE WHEN outcome = 'BUSINESS' THEN '' ELSE payload_json END
                   AS payload_json
        FROM outcomes WHERE outcome <> 'RENDERED'""",
    "documents_out": """
        SELECT event_id, loan_id,
               '<Amendment><LoanID>' || loan_id || '</LoanID><EventID>' || event_id
               || '</EventID><EffectiveDate>' || effective_date || '</EffectiveDate><Type>'
               || amendment_type || '</Type><NewRate>' || new_rate
               || '</NewRate><NewTermMonths>' || new_term_months
               || '</NewTermMonths></Amendment>' AS xml_text
        FROM outcomes WHERE outcome = 'RENDERED'""",
    "source_records": """
        SELECT o_orderkey AS id, ' order ' || o_orderkey || ' of ' || o_custkey AS column1,
               CASE WHEN o_orderkey % 6 <> 1 THEN '  ' || o_orderpriority || ' ' END AS column2,
               CAST(CASE WHEN o_orderkey % 9 = 4 THEN -price
                         WHEN o_orderkey % 13 = 6 THEN price * 10 ELSE price END
                    AS DECIMAL(10,2)) AS column3,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'SUSPENDED'
                    WHEN o_orderstatus = 'O' THEN 'ACTIVE'
                    WHEN o_orderstatus = 'F' THEN 'INACTIVE' ELSE 'PENDING' END AS status,
               o_orderdate AS created_date,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 400 DAY END
                   AS updated_date,
               'loader' AS created_by, 'loader' AS updated_by,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'CONFIDENTIAL'
                    WHEN o_orderpriority <> '5-LOW' THEN 'INTERNAL' END AS data_classification
        FROM (SELECT *, CAST(o_totalprice AS DECIMAL(10,2)) AS price FROM orders)""",
}


def _text(key: str) -> str:
    return (
        rf"""coalesce(regexp_extract(payload_json, '"{key}"\s*:\s*"([^"]*)"', 1), '') AS {key}"""
    )


def _number(key: str) -> str:
    return (
        rf"""coalesce(regexp_extract(payload_json, '"{key}"\s*:\s*"?([0-9.\-]+)', 1), '') AS {key}"""
    )


VIEWS["meta"] = VIEWS["meta"].format(
    header=", ".join(
        map(_text, ("event_id", "event_type", "event_ts", "loan_id", "source_system"))
    )
)
VIEWS["canonical"] = VIEWS["canonical"].format(
    fields=", ".join(
        [
            *map(_text, ("amendment_type", "effective_date")),
            *map(_number, ("prior_rate", "new_rate", "prior_term_months", "new_term_months")),
        ]
    )
)


def daily_summary(date: str) -> str:
    """Daily summary of one day."""
    return f"""
        SELECT CAST('{date}' AS DATE) AS date, coalesce(t.tile_id, i.tile_id) AS tile_id,
               coalesce(unique_tile_views, 0) AS unique_tile_views,
               coalesce(unique_tile_clicks, 0) AS unique_tile_clicks,
               coalesce(unique_interstitial_views, 0) AS unique_interstitial_views,
               coalesce(unique_interstitial_primary_clicks, 0)
                   AS unique_interstitial_primary_clicks,
               coalesce(unique_interstitial_secondary_clicks, 0)
                   AS unique_interstitial_secondary_clicks
        FROM ({tile_counts(date)}) t FULL JOIN ({interstitial_counts(date)}) i
        ON t.tile_id = i.tile_id"""


def tile_counts(date: str) -> str:
    return f"""
        SELECT tile_id,
               count(DISTINCT CASE WHEN event_type = 'TILE_VIEW' THEN user_id END)
                   AS unique_tile_views,
               count(DISTINCT CASE WHEN event_type = 'TILE_CLICK' THEN user_id END)
                   AS unique_tile_clicks
        FROM tile_events WHERE CAST(event_ts AS DATE) = DATE '{date}' GROUP BY tile_id"""


def interstitial_counts(date: str) -> str:
    return f"""
        SELECT tile_id,
               count(DISTINCT CASE WHEN interstitial_view_flag THEN user_id END)
                   AS unique_interstitial_views,
               count(DISTINCT CASE WHEN primary_button_click_flag THEN user_id END)
                   AS unique_interstitial_primary_clicks,
               count(DISTINCT CASE WHEN secondary_button_click_flag THEN user_id END)
                   AS unique_interstitial_secondary_clicks
        FROM interstitial_events WHERE CAST(event_ts AS DATE) = DATE '{date}' GROUP BY tile_id"""


def query(body: str, **extra: str) -> str:
    """``body`` with the views it needs in front; ``extra`` adds views of its own."""
    known = VIEWS | extra
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                need(known[name])
                if name not in needed:
                    needed.append(name)

    need(body)
    if not needed:
        return body
    views = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {views}\n{body}"
