"""Amendment events: validation, rendering and the batch as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators.sets import union_all
from tallyline.plans import amendments, domain
from tallyline.queries.registry import register
from tallyline.queries.views import query
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_pipe_csv
from tallyline.streaming import amendments as stream

_HEADER = "event_id, event_type, event_ts, loan_id, source_system"
_ENVELOPE = "kafka_key, kafka_partition, kafka_offset, ingest_ts, payload_json"
_FIELDS = "amendment_type, effective_date, prior_rate, new_rate, prior_term_months, new_term_months"


def _events(spark, folder):
    return amendments.extract_event_meta(domain.landing(spark, folder)).drop("processing_ts")


def _canonical(spark, folder):
    return amendments.canonicalize(_events(spark, folder))


@register("extract_event_meta", query(f"SELECT {_HEADER}, {_ENVELOPE} FROM meta"))
def extract_event_meta(spark, folder):
    return _events(spark, folder)


@register("canonicalize_amendment", query(f"SELECT kafka_offset, event_id, {_FIELDS} FROM canonical"))
def canonicalize_amendment(spark, folder):
    return _canonical(spark, folder).select(
        "kafka_offset", "event_id", *amendments.TEXT_FIELDS, *amendments.NUMBER_FIELDS
    )


@register("schema_reject_basic", query("SELECT kafka_offset, schema_reason AS reason FROM judged"))
def schema_reject_basic(spark, folder):
    reason = amendments.schema_reason()
    return _events(spark, folder).select("kafka_offset", reason.alias("reason"))


_WITH_NULLS = """SELECT kafka_offset, payload_json,
        CASE WHEN payload_json IS NOT NULL THEN event_id END AS event_id,
        CASE WHEN event_id <> '' THEN loan_id END AS loan_id, event_type
    FROM meta"""


@register(
    "schema_reject_strict",
    query("""SELECT kafka_offset, CASE WHEN event_id = '' THEN 'Missing event_id'
                    WHEN event_id IS NULL THEN 'Null event_id'
                    WHEN loan_id = '' THEN 'Missing loan_id'
                    WHEN loan_id IS NULL THEN 'Null loan_id'
                    WHEN event_type <> 'MORTGAGE_AMENDMENT' THEN 'Unexpected event_type'
                    WHEN payload_json IS NULL THEN 'Null payload_json' END AS reason
             FROM with_nulls""", with_nulls=_WITH_NULLS),
)
def schema_reject_strict(spark, folder):
    """Header fields with NULLs put back where nothing was found."""
    events = _events(spark, folder)
    found = F.col("payload_json").isNotNull()
    with_nulls = events.withColumns(
        {
            "event_id": F.when(found, F.col("event_id")),
            "loan_id": F.when(F.col("event_id") != "", F.col("loan_id")),
        }
    )
    reason = amendments.schema_reason(strict=True)
    return with_nulls.select("kafka_offset", reason.alias("reason"))


@register(
    "business_reject_basic",
    query("""SELECT kafka_offset, business_reason AS reason FROM basic_reasons
             WHERE schema_reason IS NULL"""),
)
def business_reject_basic(spark, folder):
    valid, _ = amendments.schema_split(_events(spark, folder))
    reason = amendments.business_reason()
    return amendments.canonicalize(valid).select("kafka_offset", reason.alias("reason"))


@register(
    "business_reject_strict",
    query("""SELECT kafka_offset, business_reason AS reason FROM strict_reasons
             WHERE schema_reason IS NULL"""),
)
def business_reject_strict(spark, folder):
    valid, _ = amendments.schema_split(_events(spark, folder), strict=True)
    reason = amendments.business_reason(strict=True)
    return amendments.canonicalize(valid).select("kafka_offset", reason.alias("reason"))


@register("schema_rejects", query("SELECT * FROM rejects WHERE reject_type = 'SCHEMA'"))
def schema_rejects(spark, folder):
    return amendments.schema_split(_events(spark, folder), strict=True)[1]


@register("business_rejects", query("SELECT * FROM rejects WHERE reject_type = 'BUSINESS'"))
def business_rejects(spark, folder):
    valid, _ = amendments.schema_split(_events(spark, folder), strict=True)
    return amendments.business_split(amendments.canonicalize(valid), strict=True)[1]


_DOCUMENTS = query(
    """SELECT event_id, loan_id, xml_text, CAST(length(xml_text) AS INTEGER) AS xml_length
       FROM documents_out"""
)


@register("rendered_amendments", _DOCUMENTS)
def rendered_amendments(spark, folder):
    outputs = amendments.process(domain.landing(spark, folder), domain.template(spark))
    return outputs.rendered.drop("processing_ts")


def _assessed(spark, folder):
    return amendments.run_batch(
        domain.landing(spark, folder), domain.template(spark), new_path(spark, "amendments")
    )


@register(
    "amendment_balance",
    query("""SELECT *, schema_rejects + business_rejects AS total_rejects,
                    CAST(schema_rejects + business_rejects AS DOUBLE) / landing_count * 100
                        AS reject_percentage,
                    schema_rejects + business_rejects + xml_output_count = landing_count
                        AS balanced
             FROM (SELECT count(*) AS landing_count,
                          count(*) FILTER (WHERE outcome = 'SCHEMA') AS schema_rejects,
                          count(*) FILTER (WHERE outcome = 'BUSINESS') AS business_rejects,
                          count(*) FILTER (WHERE outcome = 'RENDERED') AS xml_output_count
                   FROM outcomes)"""),
)
def amendment_balance(spark, folder):
    """Run the batch against stored tables and count its outcomes."""
    return amendments.balance(_assessed(spark, folder))


_OUTPUTS = query("""SELECT reject_type AS outcome, reason, event_id, loan_id, payload_json AS text
             FROM rejects
             UNION ALL SELECT 'RENDERED', NULL, event_id, loan_id, xml_text FROM documents_out""")


def _outputs(assessed):
    rejects = amendments.rejects_of(assessed).select(
        F.col("reject_type").alias("outcome"),
        "reason",
        "event_id",
        "loan_id",
        F.col("payload_json").alias("text"),
    )
    rendered = amendments.rendered_of(assessed).select(
        F.lit(amendments.RENDERED).alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
        "event_id",
        "loan_id",
        F.col("xml_text").alias("text"),
    )
    return union_all([rejects, rendered])


@register("amendment_batch", _OUTPUTS)
def amendment_batch(spark, folder):
    """All outputs of the batch, from its one stored table."""
    return _outputs(_assessed(spark, folder))


@register("amendment_release", _OUTPUTS)
def amendment_release(spark, folder):
    """The same outputs from a batch whose tables are published together."""
    released = amendments.release_batch(
        domain.landing(spark, folder), domain.template(spark), new_path(spark, "amendments")
    )
    return _outputs(released)


@register(
    "reject_rate_check",
    query("""SELECT *, CAST(total_rejects AS DOUBLE) / total_input * 100 AS reject_percentage,
                    CAST(total_rejects AS DOUBLE) / total_input * 100 > 10.0 AS exceeds_limit
             FROM (SELECT 'Schema Validation' AS step, count(*) AS total_input,
                          count(schema_reason) AS total_rejects FROM judged)
             UNION ALL
             SELECT *, CAST(total_rejects AS DOUBLE) / total_input * 100,
                    CAST(total_rejects AS DOUBLE) / total_input * 100 > 10.0
             FROM (SELECT 'Business Validation' AS step, count(*) AS total_input,
                          count(business_reason) AS total_rejects
                   FROM strict_reasons WHERE schema_reason IS NULL)"""),
)
def reject_rate_check(spark, folder):
    """Rejects of both steps from one judgement of each row."""
    return amendments.reject_rates(amendments.assess(_events(spark, folder), domain.template(spark)))


@register(
    "min_records_guard",
    query("SELECT count(*) AS records, 100 AS minimum FROM landing"),
)
def min_records_guard(spark, folder):
    return amendments.record_guard(domain.landing(spark, folder), 100)


def _sent_sql() -> str:
    fields = ", ".join(
        rf"""coalesce(regexp_extract(payload_json, '"{key}"\s*:\s*"?([^",}}]*)', 1), '') AS {key}"""
        for key in ("event_id", "loan_id", "event_type", "prior_rate")
    )
    return f"""SELECT ingest_ts, kafka_offset, {fields}
               FROM (SELECT * FROM landing UNION ALL SELECT * FROM resent)"""


@register(
    "upsert_latest_event",
    query("""SELECT event_id, ingest_ts, kafka_offset, prior_rate FROM (
               SELECT *, row_number() OVER (PARTITION BY event_id
                      ORDER BY ingest_ts DESC, kafka_offset DESC) AS n
               FROM sent WHERE event_id <> '' AND loan_id <> ''
                           AND event_type = 'MORTGAGE_AMENDMENT') WHERE n = 1""",
          sent=_sent_sql()),
)
def upsert_latest_event(spark, folder):
    """Valid events and the ones sent again, of which the later stay."""

    def valid(landing):
        events = amendments.extract_event_meta(landing).drop("processing_ts")
        return amendments.canonicalize(amendments.schema_split(events, strict=True)[0])

    return amendments.upsert_latest(
        valid(domain.landing(spark, folder)), valid(domain.resent(spark, folder))
    ).select("event_id", "ingest_ts", "kafka_offset", "prior_rate")


@register(
    "upsert_stored_events",
    query("""SELECT event_id, ingest_ts, kafka_offset, prior_rate FROM (
               SELECT *, row_number() OVER (PARTITION BY event_id
                      ORDER BY ingest_ts DESC, kafka_offset DESC) AS n
               FROM sent WHERE event_id <> '' AND loan_id <> ''
                           AND event_type = 'MORTGAGE_AMENDMENT')
             WHERE n = 1 AND (ingest_ts <> '2024-02-01T00:00:00Z' OR kafka_offset % 7 <> 0)""",
          sent=_sent_sql()),
)
def upsert_stored_events(spark, folder):
    """A stored table after events, those sent again, some taken back, and old ones arriving once more."""

    def valid(landing):
        events = amendments.extract_event_meta(landing).drop("processing_ts")
        canonical = amendments.canonicalize(amendments.schema_split(events, strict=True)[0])
        return canonical.select("event_id", "ingest_ts", "kafka_offset", "prior_rate")

    first, again = valid(domain.landing(spark, folder)), valid(domain.resent(spark, folder))
    late = F.lit("2024-02-01T00:00:01Z")
    back = again.filter("kafka_offset % 7 = 0").withColumns({"ingest_ts": late, "prior_rate": F.lit(None).cast("string")})
    path = new_path(spark, "events")
    for k, batch in enumerate((first, again, again, back, first)):
        taken_back = F.col("ingest_ts") == late
        found = amendments.upsert_stored(batch, path, new_path(spark, f"events-{k}"), deleted=taken_back)
    return found


@register(
    "amendment_stream",
    query("""SELECT outcome, coalesce(schema_reason, business_reason) AS reason, event_id, loan_id,
                    kafka_offset FROM outcomes"""),
)
def amendment_stream(spark, folder):
    """The landing rows as plain lines, payloads as they are, assessed in micro-batches."""
    incoming, out = new_path(spark, "incoming"), new_path(spark, "stream")
    rows = domain.landing(spark, folder)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns]
    rows.select(F.concat_ws("|", *fields).alias("value")).write.text(incoming)
    landing = stream.landing_stream(spark, incoming, null_value="\\N")
    stream.start(landing, domain.template(spark), out).awaitTermination()
    return stream.assessed(spark, out).select(
        "outcome", "reason", "event_id", "loan_id", "kafka_offset"
    )
