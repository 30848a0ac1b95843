"""Amendment events: landing rows to rendered documents and reject records.

All steps work row by row on native columns. Nothing is shuffled, so the same
functions take a batch or one micro-batch of a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.cleansing import processing_timestamp
from tallyline.functions.measures import count_where, percent
from tallyline.functions.text import (
    is_blank,
    is_empty,
    json_number,
    json_string,
    parse_rate,
    render_template,
    text_length,
)
from tallyline.operators.projections import computed_once, split_by_reason
from tallyline.operators.sets import union_all
from tallyline.operators.windows import latest_per_key
from tallyline.sources import keyed, releases
from tallyline.sources.writers import publish, write_path, write_pipe_csv

# Payload keys.
HEADER_FIELDS = ("event_id", "event_type", "event_ts", "loan_id", "source_system")
ENVELOPE = ("kafka_key", "kafka_partition", "kafka_offset", "ingest_ts", "payload_json")
TEXT_FIELDS = ("amendment_type", "effective_date")
NUMBER_FIELDS = ("prior_rate", "new_rate", "prior_term_months", "new_term_months")

# Event and amendment types, rate bounds, reject types and limits.
EVENT_TYPE = "MORTGAGE_AMENDMENT"
RATE_CHANGE = "RATE_CHANGE"
TERM_CHANGE = "TERM_CHANGE"
RATE_BOUNDS = (0, 50)
SCHEMA, BUSINESS, RENDERED = "SCHEMA", "BUSINESS", "RENDERED"
MAX_REJECT_PERCENTAGE = 10.0

# Reject reasons.
MISSING_EVENT_ID = "Missing event_id"
NULL_EVENT_ID = "Null event_id"
MISSING_LOAN_ID = "Missing loan_id"
NULL_LOAN_ID = "Null loan_id"
UNEXPECTED_EVENT_TYPE = "Unexpected event_type"
NULL_PAYLOAD = "Null payload_json"
MALFORMED_LINE = "Malformed line"
MISSING_EFFECTIVE_DATE = "Missing effective_date"
MISSING_AMENDMENT_TYPE = "Missing amendment_type"
MISSING_NEW_RATE = "Missing new_rate for RATE_CHANGE"
MISSING_NEW_TERM = "Missing new_term_months for TERM_CHANGE"
INVALID_RATE_RANGE = "Invalid rate range (must be 0-50%)"
INVALID_RATE_FORMAT = "Invalid rate format"

# Column order of the reject records.
REJECT_COLUMNS = (
    "reject_type",
    "reason",
    "event_id",
    "loan_id",
    "event_ts",
    "source_system",
    "kafka_partition",
    "kafka_offset",
    "ingest_ts",
    "payload_json",
)


class Rule(NamedTuple):
    """A reject reason and the condition under which it applies."""

    reason: str
    applies: Column


def first_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that is true; NULL when none is."""
    return F.coalesce(*[F.when(rule.applies, F.lit(rule.reason)) for rule in rules])


# -- extraction ---------------------------------------------------------------


def extract_event_meta(landing: DataFrame, processing_ts: Column | None = None) -> DataFrame:
    """Header fields of the payload in front of the envelope, and the mark of malformed lines."""
    header = {name: json_string("payload_json", name) for name in HEADER_FIELDS}
    stamp = processing_timestamp(processing_ts).alias("processing_ts")
    marks = ["malformed"] if "malformed" in landing.columns else []
    return computed_once(landing, header).select(*HEADER_FIELDS, *ENVELOPE, *marks, stamp)


def canonicalize(events: DataFrame, allow_quotes: bool = True) -> DataFrame:
    """Add the six amendment fields as text."""
    fields = {name: json_string("payload_json", name) for name in TEXT_FIELDS}
    fields |= {name: json_number("payload_json", name, allow_quotes) for name in NUMBER_FIELDS}
    return computed_once(events, fields)


# -- validation ---------------------------------------------------------------


def schema_reason(strict: bool = False) -> Column:
    """Why an event header is rejected.

    The basic rules let a NULL id pass, as a comparison with NULL is not true;
    the strict rules name it.
    """
    rules = [
        Rule(MISSING_EVENT_ID, F.col("event_id") == ""),
        Rule(NULL_EVENT_ID, F.col("event_id").isNull()),
        Rule(MISSING_LOAN_ID, F.col("loan_id") == ""),
        Rule(NULL_LOAN_ID, F.col("loan_id").isNull()),
        Rule(UNEXPECTED_EVENT_TYPE, F.col("event_type") != EVENT_TYPE),
        Rule(NULL_PAYLOAD, F.col("payload_json").isNull()),
    ]
    strict_only = {NULL_EVENT_ID, NULL_LOAN_ID, NULL_PAYLOAD}
    return first_reason([r for r in rules if strict or r.reason not in strict_only])


def business_reason(strict: bool = False) -> Column:
    """Why a canonical amendment is rejected; unknown amendment types pass.

    The strict rules treat whitespace as missing and look at the term and at the
    value of the rate.
    """
    missing = is_blank if strict else is_empty
    changes_rate = F.col("amendment_type") == RATE_CHANGE
    rules = [
        Rule(MISSING_EFFECTIVE_DATE, missing("effective_date")),
        Rule(MISSING_AMENDMENT_TYPE, missing("amendment_type")),
        Rule(MISSING_NEW_RATE, changes_rate & missing("new_rate")),
    ]
    if strict:
        changes_term = F.col("amendment_type") == TERM_CHANGE
        rate = parse_rate("new_rate")
        low, high = RATE_BOUNDS
        outside = ~F.isnan(rate) & ((rate < low) | (rate > high))
        rules += [
            Rule(MISSING_NEW_TERM, changes_term & missing("new_term_months")),
            Rule(INVALID_RATE_RANGE, changes_rate & outside),
            Rule(INVALID_RATE_FORMAT, changes_rate & rate.isNull()),
        ]
    return first_reason(rules)


def _as_rejects(rejected: DataFrame, kind: str) -> DataFrame:
    rows = rejected.withColumn("reject_type", F.lit(kind)).withColumnRenamed(
        "reject_reason", "reason"
    )
    if kind == BUSINESS:
        rows = rows.withColumn("payload_json", F.lit(""))
    stamp = ["processing_ts"] if "processing_ts" in rows.columns else []
    return rows.select(*REJECT_COLUMNS, *stamp)


def schema_split(events: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid events, and schema reject records with their payload."""
    valid, rejected = split_by_reason(events, schema_reason(strict))
    return valid, _as_rejects(rejected, SCHEMA)


def business_split(amendments: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid amendments, and business reject records with an empty payload."""
    valid, rejected = split_by_reason(amendments, business_reason(strict))
    return valid, _as_rejects(rejected, BUSINESS)


# -- template and rendering -----------------------------------------------------


def attach_template(
    events: DataFrame, template: DataFrame, template_key: str | None = None
) -> DataFrame:
    """Add the one template record to every event.

    The record is a scalar subquery: read once, no join. The job fails unless
    there is exactly one record, or exactly one under ``template_key``.
    """
    rows = template if template_key is None else template.filter(
        F.col("template_key") == template_key
    )
    record = F.when(
        F.count("*") == 1, F.first(F.struct("template_key", "template_text"))
    ).otherwise(F.raise_error(F.lit("expected exactly one template record")))
    single = rows.agg(record.alias("record")).scalar()
    return events.withColumn("__template", single).select(*events.columns, "__template.*")


def render(amendments: DataFrame) -> DataFrame:
    """Documents of valid amendments that carry their template."""
    text = render_template("template_text")
    rows = amendments.withColumn("xml_text", text).withColumn(
        "xml_length", text_length("xml_text")
    )
    stamp = ["processing_ts"] if "processing_ts" in rows.columns else []
    return rows.select("event_id", "loan_id", "xml_text", *stamp, "xml_length")


# -- the whole batch -------------------------------------------------------------


class Outputs(NamedTuple):
    rejects: DataFrame
    rendered: DataFrame


def process(
    landing: DataFrame,
    template: DataFrame,
    strict: bool = True,
    processing_ts: Column | None = None,
) -> Outputs:
    """Reject records of both kinds, and rendered documents."""
    events = extract_event_meta(landing, processing_ts)
    valid, schema_rejects = schema_split(events, strict)
    amendments, business_rejects = business_split(canonicalize(valid), strict)
    rendered = render(attach_template(amendments, template))
    return Outputs(union_all([schema_rejects, business_rejects]), rendered)


def assess(
    events: DataFrame, template: DataFrame, strict: bool = True
) -> DataFrame:
    """Every event once, with its outcome, reason and, if valid, its document.

    Outcomes are SCHEMA, BUSINESS and RENDERED. Written as one table with the
    outcome as partition, it yields all outputs from a single pass. Only schema
    rejects keep their payload.
    """
    reason = schema_reason(strict)
    if "malformed" in events.columns:
        reason = F.when(F.col("malformed"), F.lit(MALFORMED_LINE)).otherwise(reason)
    judged = canonicalize(events).withColumn("__schema", reason).drop("malformed")
    judged = judged.withColumn(
        "__business", F.when(F.col("__schema").isNull(), business_reason(strict))
    )
    outcome = (
        F.when(F.col("__schema").isNotNull(), F.lit(SCHEMA))
        .when(F.col("__business").isNotNull(), F.lit(BUSINESS))
        .otherwise(F.lit(RENDERED))
    )
    judged = judged.withColumns(
        {"outcome": outcome, "reason": F.coalesce("__schema", "__business")}
    ).drop("__schema", "__business")
    kept = F.when(F.col("outcome") == SCHEMA, F.col("payload_json")).otherwise(F.lit(""))
    text = F.when(F.col("outcome") == RENDERED, render_template("template_text"))
    return (
        attach_template(judged, template)
        .withColumns({"payload_json": kept, "xml_text": text})
        .drop("template_key", "template_text")
    )


def rejects_of(assessed: DataFrame) -> DataFrame:
    """Reject records of an assessed table."""
    rejected = assessed.filter(F.col("outcome").isin(SCHEMA, BUSINESS))
    return rejected.withColumnRenamed("outcome", "reject_type").select(
        *REJECT_COLUMNS, "processing_ts"
    )


def rendered_of(assessed: DataFrame) -> DataFrame:
    """Documents of an assessed table."""
    rows = assessed.filter(F.col("outcome") == RENDERED)
    return rows.select(
        "event_id",
        "loan_id",
        "xml_text",
        "processing_ts",
        text_length("xml_text").alias("xml_length"),
    )


def run_batch(
    landing: DataFrame,
    template: DataFrame,
    folder: str,
    strict: bool = True,
    processing_ts: Column | None = None,
    fmt: str = "parquet",
    minimum: int = 1,
) -> DataFrame:
    """Store raw events, then assess the stored rows; returns the assessed table.

    Raw events are on disk before any rule runs, and each payload is read once
    per step instead of once per output. They are counted where they are staged:
    a batch below the minimum fails and leaves the tables of the last one.
    """
    staged = write_path(extract_event_meta(landing, processing_ts), f"{folder}/staged", fmt=fmt)
    require_records(staged, minimum)
    raw = publish(staged, f"{folder}/raw", fmt)
    keyed.remove(raw.sparkSession, f"{folder}/staged")
    return write_path(
        assess(raw, template, strict), f"{folder}/assessed", fmt=fmt, partition_by=["outcome"]
    )


def release_batch(
    landing: DataFrame,
    template: DataFrame,
    folder: str,
    strict: bool = True,
    processing_ts: Column | None = None,
    fmt: str = "parquet",
    minimum: int = 1,
    database: str | None = None,
) -> DataFrame:
    """``run_batch`` as one release: raw and assessed events are published together, each written once."""

    def check(name: str, rows: DataFrame) -> None:
        if name == "raw":
            require_records(rows, minimum)

    written = releases.release(
        landing.sparkSession,
        folder,
        {
            "raw": lambda _: extract_event_meta(landing, processing_ts),
            "assessed": lambda done: assess(done["raw"], template, strict),
        },
        check=check,
        partition_by={"assessed": ["outcome"]},
        database=database,
        fmt=fmt,
    )
    return written["assessed"]


def write_outputs(assessed: DataFrame, folder: str, null_value: str | None = None) -> None:
    """Reject records and documents of an assessed table as pipe-delimited files."""
    write_pipe_csv(rejects_of(assessed), f"{folder}/rejects", null_value=null_value)
    write_pipe_csv(rendered_of(assessed), f"{folder}/documents", null_value=null_value)


# -- checks ------------------------------------------------------------------------


def balance(assessed: DataFrame) -> DataFrame:
    """One row: events per outcome, and whether they add up to the landing rows."""
    counted = assessed.agg(
        F.count("*").alias("landing_count"),
        *[
            count_where(F.col("outcome") == kind).alias(name)
            for kind, name in (
                (SCHEMA, "schema_rejects"),
                (BUSINESS, "business_rejects"),
                (RENDERED, "xml_output_count"),
            )
        ],
    )
    return counted.withColumns(
        {
            "total_rejects": F.col("schema_rejects") + F.col("business_rejects"),
            "reject_percentage": percent(
                F.col("schema_rejects") + F.col("business_rejects"), "landing_count"
            ),
            "balanced": F.col("schema_rejects")
            + F.col("business_rejects")
            + F.col("xml_output_count")
            == F.col("landing_count"),
        }
    )


def reject_rates(assessed: DataFrame, limit: float = MAX_REJECT_PERCENTAGE) -> DataFrame:
    """Two rows from one aggregate: rejects of the header rules, and of the others among what is left."""
    schema, business = (count_where(F.col("outcome") == kind) for kind in (SCHEMA, BUSINESS))
    counted = assessed.agg(F.count("*").alias("n"), schema.alias("s"), business.alias("b"))
    row = F.inline(
        F.array(
            *[
                F.struct(F.lit(step).alias("step"), total.alias("total_input"), F.col(part).alias("total_rejects"))
                for step, total, part in (
                    ("Schema Validation", F.col("n"), "s"),
                    ("Business Validation", F.col("n") - F.col("s"), "b"),
                )
            ]
        )
    )
    share = percent("total_rejects", "total_input")
    return counted.select(row).withColumns({"reject_percentage": share, "exceeds_limit": share > limit})


def reject_rate(
    judged: DataFrame,
    rejected: Column,
    step: str,
    limit: float = MAX_REJECT_PERCENTAGE,
) -> DataFrame:
    """One row: share of rejected rows in percent and whether it exceeds the limit."""
    counted = judged.agg(
        F.count("*").alias("total_input"), count_where(rejected).alias("total_rejects")
    )
    share = percent("total_rejects", "total_input")
    return counted.withColumns(
        {"step": F.lit(step), "reject_percentage": share, "exceeds_limit": share > limit}
    )


def record_guard(df: DataFrame, minimum: int) -> DataFrame:
    """One row with the record count; evaluating it fails below the minimum."""
    count = F.count("*")
    message = F.concat(
        F.lit("insufficient input records: "), count.cast("string"), F.lit(f" < {minimum}")
    )
    return df.agg(
        F.when(count >= minimum, count).otherwise(F.raise_error(message)).alias("records"),
        F.lit(minimum).alias("minimum"),
    )


def require_records(df: DataFrame, minimum: int) -> int:
    """Record count of a stored table; fails below the minimum."""
    return record_guard(df, minimum).first()["records"]


def upsert_latest(
    existing: DataFrame,
    incoming: DataFrame,
    key: str = "event_id",
    newest: Sequence[str] = ("ingest_ts", "kafka_offset"),
) -> DataFrame:
    """Both sides together; of several versions of a key the newest stays.

    ``existing`` is the result of earlier upserts, one row per key. Only its rows under keys
    of the batch are ranked; all others pass through, found by the keys alone, which Spark
    broadcasts when they are few.
    """
    keys = incoming.select(key).distinct()
    touched = existing.join(keys, existing[key].eqNullSafe(keys[key]), "left_semi")
    rest = existing.join(keys, existing[key].eqNullSafe(keys[key]), "left_anti")
    return union_all([rest, latest_per_key(union_all([touched, incoming]), [key], list(newest))])


def upsert_stored(
    incoming: DataFrame,
    path: str,
    staging: str,
    key: str = "event_id",
    newest: Sequence[str] = ("ingest_ts", "kafka_offset"),
    deleted: Column | None = None,
    buckets: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Upsert a batch into the keyed table below ``path`` and return the rows that are there.

    Of the batch and the stored rows of its keys the newest stays per key, a stored one where
    both are equally new; so a batch that runs again, or arrives late, changes nothing. A newest
    row for which ``deleted`` is true takes its key away. Such a key stays as a mark, so that
    an older row that arrives afterwards does not bring it back. Only rows that change are
    written; all files of earlier runs stay as they are. ``staging`` is removed in the end.
    """
    spark = incoming.sparkSession
    columns = incoming.columns
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    fresh = incoming.withColumns({keyed.GONE: gone, "__fresh": F.lit(1)})
    done = keyed.runs(spark, path)
    rows = fresh
    if done:
        known = keyed.heads(spark, path, incoming.schema, key, incoming, fmt)
        # dealt out before they are ranked: sorting for the ranking in the tasks that join would
        # add to their memory, and the known rows are one per key already
        rows = rows.unionByName(known.withColumn("__fresh", F.lit(0))).repartition(key)
    # a mark of a key that was never there is kept too: its row may arrive later
    order = [*newest, F.asc("__fresh")]
    changed = latest_per_key(rows, [key], order).filter("__fresh = 1").drop("__fresh")
    changed = write_path(changed.select(*columns, keyed.GONE), staging, fmt=fmt)
    if not done or not changed.isEmpty():
        number = done[-1].number + 1 if done else 1
        keyed.finish(spark, path, keyed.write_heads(changed, path, key, number, buckets, fmt))
        keyed.compact(spark, path, incoming.schema, key, buckets, fmt)
    keyed.remove(spark, staging)
    present = keyed.heads(spark, path, incoming.schema, key, fmt=fmt)
    return present.filter(~F.col(keyed.GONE)).select(*columns)
