"""Amendment events: extraction, reasons, rendering, batch and stream."""

import datetime as dt

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.plans import amendments
from tallyline.streaming import amendments as stream

HEAD = '"event_type":"MORTGAGE_AMENDMENT","event_ts":"2024-03-01T00:00:00Z","source_system":"S"'


def payload(event="e1", loan="l1", head=HEAD, **fields):
    text = ",".join(f'"{k}":{v}' for k, v in fields.items())
    return f'{{"event_id":"{event}","loan_id":"{loan}",{head}{"," + text if text else ""}}}'


RATE = {"amendment_type": '"RATE_CHANGE"', "effective_date": '"2024-04-01"'}
TERM = {"amendment_type": '"TERM_CHANGE"', "effective_date": '"2024-04-01"'}
EVENTS = {
    payload("ok1", **RATE, new_rate='"3.25"', new_term_months='"360"'): None,
    payload("ok2", **TERM, new_rate="4.0", new_term_months="300"): None,
    payload("", **RATE, new_rate="3"): "Missing event_id",
    payload("e3", "", **RATE, new_rate="3"): "Missing loan_id",
    payload("e4", head='"event_type":"OTHER"', **RATE, new_rate="3"): "Unexpected event_type",
    None: "Missing event_id",
    payload("e5", amendment_type='"RATE_CHANGE"', effective_date='""'): "Missing effective_date",
    payload("e6", amendment_type='" "', effective_date='"2024-04-01"'): "Missing amendment_type",
    payload("e7", **RATE, new_rate='""'): "Missing new_rate for RATE_CHANGE",
    payload("e8", **TERM): "Missing new_term_months for TERM_CHANGE",
    payload("e9", **RATE, new_rate="75.5"): "Invalid rate range (must be 0-50%)",
    payload("e10", **RATE, new_rate='"1.2.3"'): "Invalid rate format",
}


@pytest.fixture
def landing(spark):
    rows = [(f"k{i}", i % 2, i, f"2024-03-01T00:{i:02}:00Z", p) for i, p in enumerate(EVENTS)]
    return spark.createDataFrame(rows, schemas.schema("landing_event"))


@pytest.fixture
def template(spark):
    text = "<d><l>{{LOAN_ID}}</l><e>{{EVENT_ID}}</e><r>{{NEW_RATE}}</r><m>{{NEW_TERM_MONTHS}}</m></d>"
    return spark.createDataFrame([("T", text)], schemas.schema("template_record"))


def test_outputs(landing, template):
    rejects, rendered = amendments.process(landing, template)
    expected = sorted(r for r in EVENTS.values() if r)
    assert sorted(r["reason"] for r in rejects.collect()) == expected
    documents = {r["event_id"]: r["xml_text"] for r in rendered.collect()}
    assert documents == {
        "ok1": "<d><l>l1</l><e>ok1</e><r>3.25</r><m>360</m></d>",
        "ok2": "<d><l>l1</l><e>ok2</e><r>4.0</r><m>300</m></d>",
    }
    assert rejects.columns == schemas.schema("reject_record").fieldNames()
    assert rendered.columns == schemas.schema("rendered_record").fieldNames()
    assert all(r["xml_length"] == len(r["xml_text"]) for r in rendered.collect())


def test_schema_rejects_keep_and_business_rejects_lose_the_payload(landing, template):
    rejects = amendments.process(landing, template).rejects.collect()
    for row in rejects:
        if row["reject_type"] == "BUSINESS":
            assert row["payload_json"] == ""
        else:
            assert row["payload_json"] in EVENTS


def test_basic_rules_let_more_pass(landing, template):
    rejects = amendments.process(landing, template, strict=False).rejects
    assert sorted(r["reason"] for r in rejects.collect()) == sorted(
        [
            "Missing event_id",
            "Missing event_id",
            "Missing loan_id",
            "Unexpected event_type",
            "Missing effective_date",
            "Missing new_rate for RATE_CHANGE",
        ]
    )


def test_schema_reasons_on_null_headers(spark):
    rows = [
        ("e", "MORTGAGE_AMENDMENT", "l", "p"),
        ("", "MORTGAGE_AMENDMENT", "l", "p"),
        (None, "MORTGAGE_AMENDMENT", "l", "p"),
        ("e", "MORTGAGE_AMENDMENT", "", "p"),
        ("e", "MORTGAGE_AMENDMENT", None, "p"),
        ("e", "OTHER", "l", "p"),
        ("e", "MORTGAGE_AMENDMENT", "l", None),
        ("e", None, "l", "p"),
    ]
    frame = spark.createDataFrame(
        rows, "event_id string, event_type string, loan_id string, payload_json string"
    )
    strict = [r[0] for r in frame.select(amendments.schema_reason(strict=True)).collect()]
    assert strict == [
        None,
        "Missing event_id",
        "Null event_id",
        "Missing loan_id",
        "Null loan_id",
        "Unexpected event_type",
        "Null payload_json",
        None,
    ]
    basic = [r[0] for r in frame.select(amendments.schema_reason()).collect()]
    assert basic == [
        None, "Missing event_id", None, "Missing loan_id", None, "Unexpected event_type", None, None,
    ]


@pytest.mark.parametrize(
    ("date", "kind", "rate", "term", "reason"),
    [
        (None, "RATE_CHANGE", "3.5", "360", "Missing effective_date"),
        ("   ", "RATE_CHANGE", "3.5", "360", "Missing effective_date"),
        ("d", None, "3.5", "360", "Missing amendment_type"),
        ("d", "\t", "3.5", "360", "Missing amendment_type"),
        ("d", "RATE_CHANGE", " ", "360", "Missing new_rate for RATE_CHANGE"),
        ("d", "RATE_CHANGE", None, "360", "Missing new_rate for RATE_CHANGE"),
        ("d", "TERM_CHANGE", "bad", " ", "Missing new_term_months for TERM_CHANGE"),
        ("d", "RATE_CHANGE", "-0.1", "", "Invalid rate range (must be 0-50%)"),
        ("d", "RATE_CHANGE", "50.1", "", "Invalid rate range (must be 0-50%)"),
        ("d", "RATE_CHANGE", "inf", "", "Invalid rate range (must be 0-50%)"),
        ("d", "RATE_CHANGE", "bad", "", "Invalid rate format"),
        ("d", "RATE_CHANGE", "0", "", None),
        ("d", "RATE_CHANGE", "50", "", None),
        ("d", "RATE_CHANGE", "nan", "", None),
        ("d", "TERM_CHANGE", "bad", "1", None),
        ("d", "SOMETHING", None, None, None),
    ],
)
def test_strict_business_reasons(spark, date, kind, rate, term, reason):
    frame = spark.createDataFrame(
        [(date, kind, rate, term)],
        "effective_date string, amendment_type string, new_rate string, new_term_months string",
    )
    assert frame.select(amendments.business_reason(strict=True)).first()[0] == reason


def test_numbers_without_quotes_only(landing):
    events = amendments.extract_event_meta(landing)
    strict = amendments.canonicalize(events, allow_quotes=False)
    found = {r["event_id"]: r["new_rate"] for r in strict.collect()}
    assert found["ok1"] == "" and found["ok2"] == "4.0"


@pytest.mark.parametrize("records", [0, 2])
def test_template_must_be_one_record(landing, template, records):
    wrong = template.union(template) if records else template.filter("false")
    with pytest.raises((PySparkException, Py4JError), match="exactly one template"):
        amendments.attach_template(landing, wrong).collect()


def test_template_is_picked_by_key(spark, landing, template):
    other = spark.createDataFrame([("U", "text")], template.schema)
    rows = amendments.attach_template(landing, template.union(other), "U").collect()
    assert len(rows) == len(EVENTS) and {r["template_text"] for r in rows} == {"text"}


def test_batch_agrees_with_the_separate_outputs(landing, template, tmp_path):
    now = F.lit(dt.datetime(2024, 3, 2))
    assessed = amendments.run_batch(landing, template, str(tmp_path), processing_ts=now)
    separate = amendments.process(landing, template, processing_ts=now)
    rejects = amendments.rejects_of(assessed)
    assert sorted(map(str, rejects.collect())) == sorted(map(str, separate.rejects.collect()))
    rendered = amendments.rendered_of(assessed)
    assert sorted(map(str, rendered.collect())) == sorted(map(str, separate.rendered.collect()))
    counted = amendments.balance(assessed).first()
    assert counted["balanced"]
    assert tuple(counted)[:5] == (12, 4, 6, 2, 10)


def test_guard(landing, tmp_path, template):
    assert amendments.require_records(landing, 12) == 12
    with pytest.raises(PySparkException, match="insufficient input records: 12 < 13"):
        amendments.require_records(landing, 13)
    with pytest.raises(PySparkException, match="insufficient"):
        amendments.run_batch(landing.filter("false"), template, str(tmp_path))


def test_reject_rate(spark):
    rows = spark.range(10)
    exact = amendments.reject_rate(rows, F.col("id") == 0, "s").first()
    assert (exact["reject_percentage"], exact["exceeds_limit"]) == (10.0, False)
    above = amendments.reject_rate(rows, F.col("id") < 2, "s").first()
    assert (above["total_rejects"], above["exceeds_limit"]) == (2, True)
    empty = amendments.reject_rate(rows.filter("false"), F.lit(True), "s").first()
    assert (empty["reject_percentage"], empty["exceeds_limit"]) == (0.0, False)


def test_sent_again(spark):
    kind = "event_id string, ingest_ts string, kafka_offset long, rate string"
    first = spark.createDataFrame([("a", "1", 1, "3.25"), ("b", "1", 2, "4.0")], kind)
    again = spark.createDataFrame([("a", "2", 3, "3.0"), ("a", "2", 4, "2.9")], kind)
    rows = amendments.upsert_latest(first, again).collect()
    assert {(r["event_id"], r["rate"]) for r in rows} == {("a", "2.9"), ("b", "4.0")}


def test_stream_takes_each_file_once(spark, landing, template, tmp_path):
    files, out = str(tmp_path / "in"), str(tmp_path / "out")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in landing.columns]

    def land(more=()):
        lines = landing.select(F.concat_ws("|", *fields).alias("value"))
        lines.union(spark.createDataFrame([(x,) for x in more], "value string")).write.mode("append").text(files)

    land()

    def run():
        source = stream.landing_stream(spark, files, null_value="\\N")
        stream.start(source, template, out).awaitTermination()
        return stream.assessed(spark, out)

    assert run().count() == 12
    assert run().count() == 12
    land(["k|zero|1|t|{}", "too|few"])
    twice = run()
    assert twice.count() == 26
    counted = dict(twice.groupBy("outcome").count().collect())
    assert counted == {"SCHEMA": 10, "BUSINESS": 12, "RENDERED": 4}
    malformed = twice.filter(F.col("reason") == amendments.MALFORMED_LINE).select("payload_json")
    assert sorted(r[0] for r in malformed.collect()) == ["k|zero|1|t|{}", "too|few"]
