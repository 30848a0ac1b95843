"""Mappings, retention, increments, lineage, backfill and history."""

import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import governance, history

NOW = dt.datetime(2024, 6, 1, 12)


@pytest.fixture
def records(spark):
    rows = [
        (1, " ab ", " x ", Decimal("10.50"), "ACTIVE", "2024-01-01", None),
        (2, None, None, Decimal("-1.00"), "INACTIVE", "2024-02-01", "2024-05-01"),
        (3, "cd", "y", Decimal("1000000.00"), "PENDING", "2024-03-01", None),
        (4, "ef", "z", None, None, "2024-04-01", "2024-04-02"),
    ]
    kind = "id long, column1 string, column2 string, column3 decimal(10,2), status string, c string, u string"
    return spark.createDataFrame(rows, kind).selectExpr(
        "id", "column1", "column2", "column3", "status",
        "cast(c as timestamp) as created_date", "cast(u as timestamp) as updated_date",
    )


def test_mapping(records):
    mapped = governance.map_source(records, F.lit(NOW)).collect()
    assert [tuple(r)[:4] + tuple(r)[5:] for r in mapped][:2] == [
        (1, " AB ", "x", Decimal("10.50"), "A", "NEW_SOURCE", NOW),
        (2, None, None, Decimal("-1.00"), "I", "NEW_SOURCE", NOW),
    ]
    assert [r["record_status"] for r in mapped] == ["A", "I", "I", "I"]


def test_secure_mapping(records):
    extracted = records.withColumns({"data_quality_score": F.lit(1), "extraction_batch_id": F.lit("b")})
    masks = {"column1": "PARTIAL_MASK"}
    rows = governance.map_source_secure(extracted, masks, F.lit(NOW), F.lit(dt.date(2024, 1, 1))).collect()
    assert [r["new_source_column1"] for r in rows] == ["A***", "UNKNOWN", "CD***", "EF***"]
    assert [r["new_source_column2"] for r in rows] == ["x", "UNKNOWN", "y", "z"]
    assert [r["new_source_column3"] for r in rows] == [Decimal("10.50"), None, None, None]
    assert [r["record_status"] for r in rows] == ["A", "I", "P", "U"]
    assert {r["retention_date"] for r in rows} == {dt.date(2030, 12, 30)}
    assert {r["effective_end_date"] for r in rows} == {dt.datetime(9999, 12, 31, 23, 59, 59)}


def test_expiry(spark):
    frame = spark.createDataFrame(
        [(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "id int, d string"
    ).selectExpr("id", "'v' as new_source_column1", "cast(d as date) as retention_date")
    as_of = F.lit("2024-01-02").cast("date")
    values = [r["new_source_column1"] for r in governance.anonymize_expired(frame, as_of).collect()]
    assert values == ["ANONYMIZED", "v", "v"]
    later = F.lit("2031-01-02").cast("date")
    kept = governance.without_expired(frame, "retention_date", later).collect()
    assert [r["id"] for r in kept] == [2, 3]


def test_changed_since(records):
    since = F.lit("2024-03-01").cast("timestamp")
    assert [r["id"] for r in governance.changed_since(records, since).collect()] == [2, 4]
    assert [r["id"] for r in governance.changed_since(records, since, inclusive=True).collect()] == [2, 3, 4]


def test_watermark(spark, records):
    control = spark.createDataFrame(
        [("a", dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1)), ("b", dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1))],
        schemas.schema("watermark"),
    )
    update = governance.new_watermark(records, "a", "created_date", F.lit(NOW))
    merged = governance.upsert_watermark(control, update)
    empty = governance.new_watermark(records.filter("false"), "a", "created_date", F.lit(NOW))
    late = governance.new_watermark(records.limit(1), "a", "created_date", F.lit("2030-01-01").cast("timestamp"))
    for frame in (merged, governance.upsert_watermark(merged, empty), governance.upsert_watermark(merged, late)):
        marks = {r["table_name"]: r["last_processed_date"] for r in frame.collect()}
        assert marks == {"a": dt.datetime(2024, 4, 1), "b": dt.datetime(2023, 1, 1)}


def test_lineage(records):
    rows = governance.lineage_rows(records, "id", "s", "t", "m", "b", now=F.lit(NOW))
    assert rows.columns == schemas.schema("lineage").fieldNames()
    ids = [r["lineage_id"] for r in rows.collect()]
    assert len(set(ids)) == 4
    again = governance.lineage_rows(records.repartition(3), "id", "s", "t", "m", "b", now=F.lit(NOW))
    assert sorted(r["lineage_id"] for r in again.collect()) == sorted(ids)


def test_branch_backfill_resets_both_columns(spark):
    report = spark.createDataFrame(
        [(1, "kept", "2024-01-01"), (2, "lost", None), (3, None, "2024-01-01"), (4, None, None)],
        "BRANCH_ID long, REGION string, LAST_AUDIT_DATE string",
    )
    details = spark.createDataFrame(
        [(1, "N", "2020-01-01"), (2, "S", "2020-02-01"), (3, "E", None)],
        "BRANCH_ID long, REGION string, LAST_AUDIT_DATE string",
    )
    rows = governance.backfill_branch_details(report, details).orderBy("BRANCH_ID").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("kept", "2024-01-01"),
        ("S", "2020-02-01"),
        ("E", "NOT_AVAILABLE"),
        ("UNKNOWN", "NOT_AVAILABLE"),
    ]
    with pytest.raises((PySparkException, Py4JError), match="more than once"):
        governance.backfill_branch_details(report, details.union(details)).collect()


def test_schema_changes(spark):
    frame = spark.createDataFrame([(1, "a")], "BRANCH_ID int, BRANCH_NAME string")
    target = schemas.schema("branch_summary_report")
    evolved = governance.evolve_schema(frame, target, {"REGION": "UNKNOWN"})
    assert [(f.name, f.dataType) for f in evolved.schema] == [(f.name, f.dataType) for f in target]
    assert tuple(evolved.first()) == (1, "a", None, None, "UNKNOWN", None)
    assert governance.evolve_schema(evolved, target).collect() == evolved.collect()
    assert governance.drop_columns(evolved, ["REGION"]).columns == [c for c in target.fieldNames() if c != "REGION"]


def versions(spark, rows, day):
    return spark.createDataFrame(rows, "business_key long, value string").withColumns(
        {
            history.START: F.lit(day).cast("timestamp"),
            history.CHECKSUM: F.md5(F.upper("value")),
            history.CHANGE: F.md5("value"),
        }
    )


def state(df):
    return sorted(
        (r["business_key"], r["value"], r[history.CURRENT], str(r[history.START])[:10], str(r[history.END])[:10])
        for r in df.collect()
    )


def test_history(spark):
    first = history.first_versions(versions(spark, [(1, "a"), (2, "b"), (3, "c")], "2024-01-01"))
    batch = versions(spark, [(1, "a"), (2, "B"), (4, "d")], "2024-02-01")
    second = history.scd2_merge(first, batch)
    expected = [
        (1, "a", True, "2024-01-01", "9999-12-31"),
        (2, "B", True, "2024-02-01", "9999-12-31"),
        (2, "b", False, "2024-01-01", "2024-02-01"),
        (3, "c", True, "2024-01-01", "9999-12-31"),
        (4, "d", True, "2024-02-01", "9999-12-31"),
    ]
    assert state(second) == expected
    assert state(history.scd2_merge(second, batch)) == expected
    third = history.scd2_merge(second, versions(spark, [(2, "b")], "2024-03-01"))
    assert [r for r in state(third) if r[0] == 2] == [
        (2, "B", False, "2024-02-01", "2024-03-01"),
        (2, "b", False, "2024-01-01", "2024-02-01"),
        (2, "b", True, "2024-03-01", "9999-12-31"),
    ]
    keys = [r[history.SURROGATE] for r in third.collect()]
    assert len(set(keys)) == len(keys) and third.columns == first.columns


def test_late_versions_and_several_of_one_key(spark):
    first = history.first_versions(versions(spark, [(1, "b")], "2024-02-01"))
    late = versions(spark, [(1, "a")], "2024-01-01").union(versions(spark, [(1, "c")], "2024-02-15"))
    for _ in range(2):
        first = history.scd2_merge(first, late)
        assert state(first) == [
            (1, "a", False, "2024-01-01", "2024-02-01"),
            (1, "b", False, "2024-02-01", "2024-02-15"),
            (1, "c", True, "2024-02-15", "9999-12-31"),
        ]
    assert state(history.scd2_merge(first, late.filter("false"))) == state(first)


def test_change_hash_sees_nulls_masks_and_places(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a|", "b"), ("a", "|b"), ("abc", "x"), ("abzzz", "x")]
    frame = spark.createDataFrame(rows, "a string, b string")
    hashes = [r[0] for r in frame.select(governance.change_hash(["a", "b"])).collect()]
    assert len(set(hashes)) == len(rows)


def test_evolving_drops_no_column(spark):
    target = schemas.schema("template_record")
    with pytest.raises(ValueError, match="extra"):
        governance.evolve_schema(spark.sql("select 'k' as template_key, 1 as extra"), target)


def test_history_starts_from_nothing(spark):
    batch = versions(spark, [(1, "a")], "2024-01-01")
    nothing = history.first_versions(batch).filter("false")
    assert state(history.scd2_merge(nothing, batch)) == [(1, "a", True, "2024-01-01", "9999-12-31")]
