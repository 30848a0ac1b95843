"""Declared schemas of the source and target tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    # regulatory reporting
    "customer": "CUSTOMER_ID int, NAME string, EMAIL string, PHONE string, ADDRESS string, CREATED_DATE date",
    "branch": (
        "BRANCH_ID int, BRANCH_NAME string, BRANCH_CODE string, CITY string, STATE string, COUNTRY string"
    ),
    "account": (
        "ACCOUNT_ID int, CUSTOMER_ID int, BRANCH_ID int, ACCOUNT_NUMBER string, ACCOUNT_TYPE string, "
        "BALANCE decimal(15,2), OPENED_DATE date"
    ),
    "transaction": (
        "TRANSACTION_ID int, ACCOUNT_ID int, TRANSACTION_TYPE string, AMOUNT decimal(15,2), "
        "TRANSACTION_DATE date, DESCRIPTION string"
    ),
    "branch_operational_details": (
        "BRANCH_ID int, REGION string, MANAGER_NAME string, LAST_AUDIT_DATE date, IS_ACTIVE string"
    ),
    "aml_customer_transactions": (
        "CUSTOMER_ID int, NAME string, ACCOUNT_ID int, TRANSACTION_ID int, AMOUNT decimal(15,2), "
        "TRANSACTION_TYPE string, TRANSACTION_DATE date"
    ),
    "branch_summary_report": (
        "BRANCH_ID bigint, BRANCH_NAME string, TOTAL_TRANSACTIONS bigint, TOTAL_AMOUNT double, "
        "REGION string, LAST_AUDIT_DATE string"
    ),
    # engagement reporting
    "home_tile_events": (
        "event_id string, user_id string, session_id string, event_ts timestamp, tile_id string, "
        "event_type string, device_type string, app_version string"
    ),
    "interstitial_events": (
        "event_id string, user_id string, session_id string, event_ts timestamp, tile_id string, "
        "interstitial_view_flag boolean, primary_button_click_flag boolean, "
        "secondary_button_click_flag boolean"
    ),
    "tile_metadata": (
        "tile_id string, tile_name string, tile_category string, is_active boolean, updated_ts timestamp"
    ),
    "tile_daily_summary": (
        "date date, tile_id string, tile_category string, unique_tile_views bigint, "
        "unique_tile_clicks bigint, unique_interstitial_views bigint, "
        "unique_interstitial_primary_clicks bigint, unique_interstitial_secondary_clicks bigint"
    ),
    "tile_global_kpis": (
        "date date, total_tile_views bigint, total_tile_clicks bigint, total_interstitial_views bigint, "
        "total_primary_clicks bigint, total_secondary_clicks bigint, overall_ctr double, "
        "overall_primary_ctr double, overall_secondary_ctr double"
    ),
    # amendment events
    "landing_event": (
        "kafka_key string, kafka_partition int, kafka_offset bigint, ingest_ts string, payload_json string"
    ),
    "template_record": "template_key string, template_text string",
    "event_meta": (
        "event_id string, event_type string, event_ts string, loan_id string, source_system string, "
        "kafka_key string, kafka_partition int, kafka_offset bigint, ingest_ts string, "
        "payload_json string, processing_ts timestamp"
    ),
    "reject_record": (
        "reject_type string, reason string, event_id string, loan_id string, event_ts string, "
        "source_system string, kafka_partition int, kafka_offset bigint, ingest_ts string, "
        "payload_json string, processing_ts timestamp"
    ),
    "rendered_record": (
        "event_id string, loan_id string, xml_text string, processing_ts timestamp, xml_length int"
    ),
    # generic source, history and control tables
    "source_record": (
        "id bigint, column1 string, column2 string, column3 decimal(10,2), status string, "
        "created_date timestamp, updated_date timestamp, created_by string, updated_by string, "
        "data_classification string, checksum string, version_number int"
    ),
    "watermark": "table_name string, last_processed_date timestamp, updated_timestamp timestamp",
    "lineage": (
        "lineage_id string, source_table string, target_table string, record_id bigint, "
        "transformation_applied string, processed_timestamp timestamp, batch_id string, "
        "data_quality_score decimal(5,2)"
    ),
    "audit": (
        "operation string, table_name string, record_count bigint, processing_time_seconds double, "
        "user string, timestamp timestamp, application string, version string"
    ),
}


def schema(name: str) -> StructType:
    """Schema of one of the tables above."""
    return StructType.fromDDL(_DDL[name])


def names() -> list[str]:
    return list(_DDL)
