"""Checks, reconciliation, monitoring and clustering on small frames."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import clustering, monitoring, quality, reconciliation
from tallyline.sources.readers import table_or_empty
from tallyline.sources.writers import write_path
from tests.plans import planned


@pytest.fixture
def report(spark):
    rows = [
        (1, "a", 3, 10.0, "NORTH", "2024-01-15"),
        (2, "b", 2, -5.0, "UNKNOWN", None),
        (2, "c", 1, 7.0, None, "2024-01-20"),
        (4, None, 1, 7.0, "CENTRE", "2024-01-20"),
    ]
    return spark.createDataFrame(rows, schemas.schema("branch_summary_report"))


def test_basic(report):
    assert tuple(quality.basic_check(report, "t", ["BRANCH_ID"]).first()) == ("t", 4, 0, True)
    assert tuple(quality.basic_check(report, "t", ["BRANCH_ID", "REGION"]).first()) == ("t", 4, 1, False)
    assert not quality.basic_check(report.filter("false"), "t", ["BRANCH_ID"]).first()["passed"]


def test_integrity(report):
    found = quality.integrity_check(report, "t", ["BRANCH_ID"]).first()
    assert tuple(found) == ("t", 4, 0, 1, 1, False)
    # duplicates alone only warn
    clean = quality.integrity_check(report.filter("TOTAL_AMOUNT > 0 or REGION is null"), "t", ["BRANCH_ID"])
    assert clean.first()["passed"]
    doubled = report.filter("BRANCH_ID = 1").union(report.filter("BRANCH_ID = 1"))
    again = quality.integrity_check(doubled, "t", ["BRANCH_ID"]).first()
    assert (again["duplicated_keys"], again["passed"]) == (1, True)
    nulls = quality.integrity_check(report.filter("TOTAL_AMOUNT > 0"), "t", ["BRANCH_NAME"]).first()
    assert (nulls["null_keys"], nulls["passed"]) == (1, False)
    empty = quality.integrity_check(report.filter("false"), "t", ["BRANCH_ID"]).first()
    assert tuple(empty) == ("t", 0, 0, 0, 0, False)


def test_rules(report):
    rules = [
        quality.Rule("id", "BRANCH_ID IS NOT NULL"),
        quality.Rule("amount", "TOTAL_AMOUNT >= 0", "WARNING"),
    ]
    found = {r["rule_name"]: r for r in quality.rule_check(report, "t", rules).collect()}
    assert found["amount"]["violations"] == 1 and found["amount"]["status"] == "FAILED"
    assert {r["overall_status"] for r in found.values()} == {"PASSED"}
    # a NULL region is no violation
    taxonomy = quality.rule_check(report, "t", [quality.taxonomy_rule("REGION")]).first()
    assert (taxonomy["violations"], taxonomy["overall_status"]) == (2, "FAILED")


def test_required_schema(report):
    required = schemas.schema("branch_summary_report")
    critical = ["BRANCH_ID", "BRANCH_NAME"]
    found = {r["column_name"]: r for r in quality.required_schema_check(report, required, critical).collect()}
    assert [n for n, r in found.items() if not r["passed"]] == ["BRANCH_NAME"]
    assert found["BRANCH_NAME"]["null_count"] == 1
    other = report.drop("REGION").withColumn("TOTAL_AMOUNT", F.col("TOTAL_AMOUNT").cast("float"))
    found = {r["column_name"]: r for r in quality.required_schema_check(other, required, ["BRANCH_ID"]).collect()}
    assert [n for n, r in found.items() if not r["passed"]] == ["TOTAL_AMOUNT", "REGION"]
    assert found["REGION"]["actual_type"] is None


def test_null_profile(spark):
    frame = spark.range(100).selectExpr("id", "if(id < 6, null, 'x') as column1", "if(id < 50, null, 1) as other")
    found = {r["column_name"]: r for r in quality.null_profile(frame).collect()}
    assert found["column1"]["null_percentage"] == 6.0
    assert {r["status"] for r in found.values()} == {"FAILED"}
    found = quality.null_profile(frame.filter("id >= 1 and id < 100")).collect()
    assert {r["status"] for r in found} == {"FAILED"}
    found = quality.null_profile(frame.withColumn("column1", F.lit("x"))).collect()
    assert {r["status"] for r in found} == {"PASSED"}
    empty = quality.null_profile(frame.filter("false")).collect()
    assert {(r["null_count"], r["null_percentage"], r["status"]) for r in empty} == {(0, 0.0, "PASSED")}


def test_score_counts_a_row_once_per_issue(spark):
    kind = "event_id string, loan_id string, event_type string, effective_date string, new_rate string"
    frame = spark.createDataFrame(
        [("e", "l", "MORTGAGE_AMENDMENT", "d", "3.5"), ("", None, "X", "", "99"), ("e", "l", None, "d", "bad")],
        kind,
    )
    found = quality.amendment_score(frame).first()
    assert tuple(found) == (3, 1, 1, 1, 1, 1, -66.67)
    assert quality.amendment_score(frame.filter("false")).first()["quality_score_percentage"] is None


def test_gate(spark):
    as_of = F.lit("2024-06-01").cast("timestamp")
    good = spark.range(10).selectExpr(
        "id", "'x' as column1", "'y' as column2", "cast(id as decimal(10,2)) as column3",
        "timestamp'2024-01-01' as created_date",
    )
    parent = spark.range(10)
    gate = quality.quality_gate(good, ["id"], parent, "id", "id", as_of).first()
    assert tuple(gate) == (6, 6, 1.0, True)
    gate = quality.quality_gate(good, ["id"], spark.range(9), "id", "id", as_of).first()
    assert (gate["passed_checks"], gate["is_valid"]) == (5, False)
    other = good.withColumn("ref", F.col("id") % 3)
    twice = other.unionByName(other.limit(1))
    gate = quality.quality_gate(twice, ["id"], spark.range(2), "id", "ref", as_of).first()
    assert gate["passed_checks"] == 4


def test_gate_of_no_rows_is_not_valid(spark):
    none = spark.createDataFrame([], "id long, column1 string, column2 string, column3 decimal(10,2), created_date timestamp")
    gate = quality.quality_gate(none, ["id"], spark.range(1), "id", "id", threshold=0.5).first()
    assert (gate["passed_checks"], gate["is_valid"]) == (5, False)


def test_gate_reads_the_table_once(spark, tmp_path):
    rows = spark.sql("select 1 as id, 'x' as column1, 2.0 as column3, current_timestamp() as created_date")
    stored = write_path(rows, str(tmp_path / "child"))
    gate = quality.quality_gate(stored, ["id"], spark.range(9), "id", "id")
    assert planned(gate).count("FileScan") == 1


def test_rate_and_slowness(spark):
    steps = spark.createDataFrame(
        [("a", 600, 2.0), ("b", 10, 301.0), ("c", 5, 0.0), ("d", 0, 300.0)],
        "step_name string, row_count long, duration_seconds double",
    )
    found = {r["step_name"]: (r["rows_per_second"], r["is_slow"]) for r in monitoring.throughput(steps).collect()}
    assert found == {"a": (300.0, False), "b": (10 / 301.0, True), "c": (0.0, False), "d": (0.0, False)}


def test_availability_of_a_missing_table(spark):
    frame = table_or_empty(spark, "no_such_table_here", schemas.schema("tile_metadata"))
    found = quality.dimension_availability(frame, F.col("is_active"), {"tile_category": "nulls"}).first()
    assert tuple(found) == (0, 0, 0, False)


def test_reconcile(report, spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "BRANCH_ID long")
    filled = reconciliation.populated("REGION")
    found = {r["check_name"]: r for r in reconciliation.reconcile(source, report, "BRANCH_ID", filled).collect()}
    assert tuple(found["record_count"])[1:4] == (3.0, 4.0, False)
    assert tuple(found["missing_in_target"])[1:4] == (0.0, 1.0, False)
    assert tuple(found["extra_in_target"])[1:4] == (0.0, 1.0, False)
    assert tuple(found["region_population"])[1:4] == (2.0, 50.0, None)
    assert {r["overall_status"] for r in found.values()} == {"FAILED"}
    same = reconciliation.reconcile(report, report, "BRANCH_ID", filled).collect()
    assert {r["overall_status"] for r in same} == {"PASSED"}
    empty = report.filter("false")
    assert reconciliation.reconcile(empty, empty, "BRANCH_ID", filled).first()["overall_status"] == "PASSED"


def test_coverage_and_alerts(report):
    found = monitoring.coverage(report)
    assert tuple(found.first()) == (4, 2, 3, 50.0, 75.0)
    messages = [r["message"] for r in monitoring.alerts(found).collect()]
    assert messages == [
        "Region coverage is 50.0%, below threshold of 85.0%",
        "Audit date coverage is 75.0%, below threshold of 90.0%",
    ]
    limits = {"region_coverage_percent": monitoring.Limit("Region coverage", 50.0)}
    assert monitoring.alerts(found, limits).count() == 0
    above = {"region_coverage_percent": monitoring.Limit("Region coverage", 20.0, minimum=False)}
    assert monitoring.alerts(found, above).first()["message"] == (
        "Region coverage is 50.0%, above threshold of 20.0%"
    )


def test_run_limits(spark):
    slow = spark.sql("select 1800.5D as duration_seconds, 96.0D as quality_score_percentage")
    found = monitoring.alerts(slow, monitoring.RUN_LIMITS, "RUN_WARNING").collect()
    assert [(r["type"], r["message"]) for r in found] == [
        ("RUN_WARNING", "Processing time is 1800.5 s, above threshold of 1800.0 s")
    ]


def test_freshness_counts_inactive_audits_over_active_branches(spark):
    frame = spark.createDataFrame(
        [("2024-01-01", "Y"), ("2024-01-01", "N"), ("2024-05-30", "Y"), (None, "Y")],
        "LAST_AUDIT_DATE string, IS_ACTIVE string",
    ).withColumn("LAST_AUDIT_DATE", F.col("LAST_AUDIT_DATE").cast("date"))
    found = monitoring.audit_freshness(frame, F.lit("2024-06-01").cast("date")).first()
    assert tuple(found) == (2, 3, 2 / 3 * 100)


def test_step_metrics(spark, tmp_path):
    steps = monitoring.StepMetrics()
    whole = steps.watch(spark.range(0, 1000, 1, 4), "read")
    part = steps.watch(whole.filter("id < 10"), "filter")
    assert part.columns == ["id"]
    with pytest.raises(ValueError, match="no action"):
        steps.frame(spark)
    time.sleep(0.5)
    with steps.action():
        write_path(part, str(tmp_path / "out"))
    time.sleep(0.5)
    found = monitoring.throughput(steps.frame(spark, dt.datetime(2024, 1, 1))).collect()
    assert [(r["step_name"], r["row_count"]) for r in found] == [("read", 1000), ("filter", 10)]
    assert found[0]["partition_count"] == 4
    assert all(r["rows_per_second"] > 0 and not r["is_slow"] for r in found)


def test_audit_row(spark):
    found = monitoring.audit_row(spark.range(7), "WRITE", "t", "u", "app", "1", 2.0).first()
    assert found["record_count"] == 7 and found["timestamp"] is not None
    declared = schemas.schema("audit").fieldNames()
    assert sorted(found.asDict()) == sorted(declared)


def test_anomalies_against_numpy(spark):
    source = np.random.default_rng(5)
    points = np.vstack([source.normal(c, 1.0, (400, 2)) for c in (0, 50, 100)])
    points = np.vstack([points, [[25.0, 25.0], [130.0, 90.0]]])
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    found = clustering.kmeans_anomalies(frame, ["x", "y"], quantile=0.99).collect()
    assert {1200, 1201} <= {r["i"] for r in found}
    # distances and limits once more, from the clusters that were found
    rows = clustering.kmeans_partitioning(frame, ["x", "y"], k=3, seed=42).collect()
    cluster = np.array([r["prediction"] for r in sorted(rows, key=lambda r: r["i"])])
    expected = set()
    for label in range(3):
        members = np.flatnonzero(cluster == label)
        distance = np.linalg.norm(points[members] - points[members].mean(axis=0), axis=1)
        limit = np.sort(distance)[int(np.ceil(0.99 * len(members))) - 1]
        expected |= set(members[distance > limit].tolist())
    assert {r["i"] for r in found} == expected


def test_anomalies_need_two_numeric_columns(spark):
    frame = spark.createDataFrame([(1, "a")], "i int, t string")
    empty = clustering.kmeans_anomalies(frame)
    assert empty.columns == ["i", "t", "cluster", "distance"] and empty.count() == 0
