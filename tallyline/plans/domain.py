"""The report tables as views of a star schema with orders and click events.

Customers double as accounts, orders as transactions, nations as branches.
Events feed the tile, interstitial and amendment tables, parts the tile
metadata, orders the generic source records. Some values are blanked or dropped
by id so that every rule of the reports meets rows it applies to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.text import json_number
from tallyline.operators.projections import computed_once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _every(column: str, n: int, remainder: int) -> Column:
    return F.col(column) % n == remainder


# -- regulatory ----------------------------------------------------------------------


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("CUSTOMER_ID"), F.col("c_name").alias("NAME")
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ACCOUNT_ID"),
        F.col("c_custkey").alias("CUSTOMER_ID"),
        F.col("c_nationkey").alias("BRANCH_ID"),
        F.col("c_mktsegment").alias("ACCOUNT_TYPE"),
        F.col("c_acctbal").cast("decimal(15,2)").alias("BALANCE"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("TRANSACTION_ID"),
        F.col("o_custkey").alias("ACCOUNT_ID"),
        F.col("o_orderstatus").alias("TRANSACTION_TYPE"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("AMOUNT"),
        F.col("o_orderdate").cast("date").alias("TRANSACTION_DATE"),
    )


def branches(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("BRANCH_ID"), F.col("n_name").alias("BRANCH_NAME")
    )


def branch_details(spark: SparkSession, folder: str) -> DataFrame:
    """One row per branch outside the Middle East; some gaps, some branches inactive."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.filter(F.col("r_name") != "MIDDLE EAST").select(
        F.col("n_nationkey").alias("BRANCH_ID"),
        F.when(~_every("n_nationkey", 11, 5), F.col("r_name")).alias("REGION"),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("MANAGER_NAME"),
        F.when(
            ~_every("n_nationkey", 7, 2),
            F.date_add(F.lit("2023-01-01").cast("date"), F.col("n_nationkey")),
        ).alias("LAST_AUDIT_DATE"),
        F.when(_every("n_nationkey", 3, 0), F.lit("N")).otherwise(F.lit("Y")).alias("IS_ACTIVE"),
    )


def branch_details_history(spark: SparkSession, folder: str) -> DataFrame:
    """The details and a second version of each row, audited a month later."""
    first = branch_details(spark, folder)
    later = first.withColumns(
        {
            "MANAGER_NAME": F.concat(F.lit("Deputy "), F.col("MANAGER_NAME")),
            "LAST_AUDIT_DATE": F.add_months("LAST_AUDIT_DATE", 1),
        }
    )
    return first.unionByName(later)


# -- engagement ------------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    number = json_number("props", "k").cast("int")
    return computed_once(table(spark, folder, "events"), {"k": number})


def tile_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events without tile where the number is 13."""
    kind = (
        F.when(F.col("event_type") == "view", F.lit("TILE_VIEW"))
        .when(F.col("event_type") == "click", F.lit("TILE_CLICK"))
        .otherwise(F.upper("event_type"))
    )
    return _events(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("event_ts"),
        F.when(F.col("k") != 13, F.concat(F.lit("TILE_"), F.col("k"))).alias("tile_id"),
        kind.alias("event_type"),
    )


def interstitial_events(spark: SparkSession, folder: str) -> DataFrame:
    """Tile numbers are shifted by 20, so that either side has tiles of its own."""
    kind = F.col("event_type")
    return _events(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("event_ts"),
        F.when(F.col("k") != 13, F.concat(F.lit("TILE_"), F.col("k") + 20)).alias("tile_id"),
        F.when(kind != "view", kind == "signup").alias("interstitial_view_flag"),
        (kind == "purchase").alias("primary_button_click_flag"),
        (kind == "error").alias("secondary_button_click_flag"),
    )


def tile_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata starts at tile 40; the tiles below have none."""
    return table(spark, folder, "part").select(
        F.concat(F.lit("TILE_"), F.col("p_partkey") + 40).alias("tile_id"),
        F.col("p_name").alias("tile_name"),
        F.col("p_type").alias("tile_category"),
        _every("p_size", 2, 0).alias("is_active"),
        F.date_add(F.lit("2023-06-01").cast("date"), F.col("p_size"))
        .cast("timestamp_ntz")
        .alias("updated_ts"),
    )


def tile_metadata_history(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata and an older version of each row under another category."""
    current = tile_metadata(spark, folder)
    older = current.withColumns(
        {
            "tile_category": F.lit("LEGACY"),
            "updated_ts": F.col("updated_ts") - F.expr("INTERVAL 30 DAYS"),
        }
    )
    return current.unionByName(older)


# -- amendments --------------------------------------------------------------------------


def landing(spark: SparkSession, folder: str) -> DataFrame:
    """One landing row per event; the remainder of the id by 12 decides on its flaw."""

    def flawed(remainder: int, value: str, otherwise: Column) -> Column:
        return F.when(F.col("slot") == remainder, F.lit(value)).otherwise(otherwise)

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    events = table(spark, folder, "events").withColumn("slot", F.col("event_id") % 12)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rate = F.col("value").cast("decimal(10,2)").cast("string")
    is_rate = F.col("event_type").isin("signup", "purchase", "error")
    new_rate = (
        F.when(F.col("slot") == 7, F.lit('""'))
        .when(F.col("slot") == 8, F.lit('"1.2.3"'))
        .when(F.col("slot") == 9, F.lit("-1"))
        .when(F.col("event_type") == "error", quoted(rate))
        .otherwise(rate)
    )
    payload = F.concat(
        F.lit('{"event_id":"'),
        flawed(0, "", F.concat(F.lit("evt"), F.col("event_id"))),
        F.lit('","event_type":"'),
        flawed(2, "OTHER_EVENT", F.lit("MORTGAGE_AMENDMENT")),
        F.lit('","event_ts":"'),
        stamp,
        F.lit('", "loan_id" : "'),
        flawed(1, "", F.concat(F.lit("loan"), F.col("user_id"))),
        F.lit('","source_system":"CORE","amendment_type":"'),
        flawed(6, "", F.when(is_rate, F.lit("RATE_CHANGE")).otherwise(F.lit("TERM_CHANGE"))),
        F.lit('","effective_date":"'),
        flawed(4, "", flawed(5, "  ", F.date_format("ts", "yyyy-MM-dd"))),
        F.lit('","prior_rate":3.75,"new_rate":'),
        new_rate,
        F.lit(',"prior_term_months":"360","new_term_months":'),
        flawed(10, '""', (F.col("user_id") % 30 * 12 + 12).cast("string")),
        F.lit("}"),
    )
    text = F.when(F.col("slot") != 3, payload)
    return computed_once(events, {"payload_json": text, "ingest_ts": stamp}).select(
        F.concat(F.lit("key"), F.col("user_id")).alias("kafka_key"),
        (F.col("event_id") % 4).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        "ingest_ts",
        "payload_json",
    )


def resent(spark: SparkSession, folder: str) -> DataFrame:
    """Rate changes sent again later with another prior rate."""
    sent = landing(spark, folder).filter(F.contains("payload_json", F.lit("RATE_CHANGE")))
    return sent.withColumns(
        {
            "kafka_offset": F.col("kafka_offset") + 1_000_000_000,
            "ingest_ts": F.lit("2024-02-01T00:00:00Z"),
            "payload_json": F.replace(
                F.col("payload_json"), F.lit('"prior_rate":3.75'), F.lit('"prior_rate":3.25')
            ),
        }
    )


TEMPLATE_KEY = "AMENDMENT"
TEMPLATE_TEXT = (
    "<Amendment><LoanID>{{LOAN_ID}}</LoanID><EventID>{{EVENT_ID}}</EventID>"
    "<EffectiveDate>{{EFFECTIVE_DATE}}</EffectiveDate><Type>{{AMENDMENT_TYPE}}</Type>"
    "<NewRate>{{NEW_RATE}}</NewRate><NewTermMonths>{{NEW_TERM_MONTHS}}</NewTermMonths></Amendment>"
)


def template(spark: SparkSession) -> DataFrame:
    """The template record, a parameter of the amendment job."""
    return spark.range(1).select(
        F.lit(TEMPLATE_KEY).alias("template_key"), F.lit(TEMPLATE_TEXT).alias("template_text")
    )


# -- source records -------------------------------------------------------------------------


def source_records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as generic records with gaps, odd statuses and amounts out of range."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(10,2)")
    amount = (
        F.when(key % 9 == 4, -price).when(key % 13 == 6, price * 10).otherwise(price)
    ).cast("decimal(10,2)")
    status = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("SUSPENDED"))
        .when(F.col("o_orderstatus") == "O", F.lit("ACTIVE"))
        .when(F.col("o_orderstatus") == "F", F.lit("INACTIVE"))
        .otherwise(F.lit("PENDING"))
    )
    classification = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("CONFIDENTIAL"))
        .when(F.col("o_orderpriority") != "5-LOW", F.lit("INTERNAL"))
    )
    return table(spark, folder, "orders").select(
        key.alias("id"),
        F.concat(F.lit(" order "), key.cast("string"), F.lit(" of "), F.col("o_custkey")).alias(
            "column1"
        ),
        F.when(key % 6 != 1, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias(
            "column2"
        ),
        amount.alias("column3"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_date"),
        F.when(
            F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")
        ).alias("updated_date"),
        F.lit("loader").alias("created_by"),
        F.lit("loader").alias("updated_by"),
        classification.alias("data_classification"),
    )


def record_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A later state of the records: those of status PENDING have a new text and date."""
    records, pending = source_records(spark, folder), F.col("status") == "PENDING"
    return records.withColumns(
        {
            "column1": F.when(pending, F.concat("column1", F.lit(" changed"))).otherwise(
                F.col("column1")
            ),
            "updated_date": F.when(
                pending, F.col("updated_date") + F.expr("INTERVAL 1 DAY")
            ).otherwise(F.col("updated_date")),
        }
    )
