"""Filters, joins, windows, sets and layout on small frames."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JError
from pyspark.sql import functions as F

from tallyline.functions import cleansing, measures, protection
from tallyline.operators import joins, layout, projections, sets
from tallyline.operators.windows import latest_per_key

FAILURES = (PySparkException, Py4JError)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_on_date_takes_the_whole_day_and_nothing_else(spark):
    stamps = ["2024-01-04 23:59:59.999999", "2024-01-05 00:00:00", "2024-01-05 23:59:59.999999", "2024-01-06 00:00:00", None]
    frame = spark.createDataFrame([(s,) for s in stamps], "s string")
    for kind in ("timestamp", "timestamp_ntz"):
        typed = frame.select("s", F.col("s").cast(kind).alias("ts"))
        for day in ("2024-01-05", dt.date(2024, 1, 5), F.lit("2024-01-05").cast("date")):
            assert [r["s"] for r in projections.on_date(typed, "ts", day).collect()] == stamps[1:3]


def test_row_security_hides_unclassified_rows_too(spark):
    frame = spark.createDataFrame([("CONFIDENTIAL",), ("INTERNAL",), (None,)], "data_classification string")
    assert rows(projections.visible_rows(frame, "RESTRICTED")) == [("INTERNAL",)]
    assert projections.visible_rows(frame, "FULL").count() == 3
    assert projections.visible_rows(frame, None).count() == 3


def test_split_is_complete(spark):
    frame = spark.range(10)
    valid, rejected = projections.split_by_reason(frame, F.when(F.col("id") % 3 == 0, F.lit("third")))
    assert valid.count() == 6 and valid.columns == ["id"]
    assert rows(rejected) == [(0, "third"), (3, "third"), (6, "third"), (9, "third")]


def test_computed_once_replaces_and_appends(spark):
    frame = spark.range(2).withColumn("a", F.lit("x"))
    out = projections.computed_once(frame, {"a": F.concat("a", F.col("id")), "b": F.col("id") + 1})
    assert out.columns == ["id", "a", "b"]
    assert rows(out) == [(0, "x0", 1), (1, "x1", 2)]


def test_to_target_orders_and_casts(spark):
    from tallyline import schemas

    frame = spark.sql("select 'x' as BRANCH_NAME, 1 as BRANCH_ID, 2.5BD as TOTAL_AMOUNT, 3 as extra")
    out = projections.to_target(frame, schemas.schema("branch_summary_report"))
    assert out.dtypes == [("BRANCH_ID", "bigint"), ("BRANCH_NAME", "string"), ("TOTAL_AMOUNT", "double")]


def test_latest_per_key_puts_nulls_last(spark):
    frame = spark.createDataFrame(
        [(1, None, "a"), (1, 3, "b"), (1, 3, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")],
        "k int, d int, v string",
    )
    assert rows(latest_per_key(frame, ["k"], ["d", "v"])) == [(1, 3, "c"), (2, None, "d"), (None, 2, "f")]


def test_key_comparisons(spark):
    source = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert rows(joins.key_reconcile(source, target, "k")) == [
        (1, "missing_in_target"),
        (3, "extra_in_target"),
        (None, "missing_in_target"),
    ]
    assert joins.unmatched_count(source, target, "k").first()[0] == 3
    assert tuple(joins.referential_integrity(source, target, "k", "k").first()) == (1, 2)
    nothing = source.filter("false")
    assert joins.unmatched_count(nothing, target, "k").first()[0] == 0
    assert tuple(joins.referential_integrity(nothing, target, "k", "k").first()) == (0, 0)


def test_safe_dimension_join(spark):
    base = spark.createDataFrame([(1,), (2,)], "BRANCH_ID int")
    details = spark.createDataFrame(
        [(1, "2024-01-01", "old"), (1, "2024-02-01", "new"), (3, None, "x")],
        "BRANCH_ID int, LAST_AUDIT_DATE string, REGION string",
    )
    joined = joins.safe_dimension_join(base, details, "BRANCH_ID", ["LAST_AUDIT_DATE"])
    assert rows(joined) == [(1, "2024-02-01", "new"), (2, None, None)]
    with pytest.raises(ValueError, match="no rows"):
        joins.safe_dimension_join(base.filter("false"), details, "BRANCH_ID", ["LAST_AUDIT_DATE"])


def test_scalar_backfill(spark):
    frame = spark.createDataFrame([(1, None), (2, "kept"), (3, None), (4, None), (None, None)], "k int, c string")
    lookup = spark.createDataFrame([(1, "found"), (2, "other"), (3, None)], "k int, c string")
    filled = joins.scalar_backfill(frame, lookup, "k", {"c": "default"})
    assert rows(filled) == [(1, "found"), (2, "kept"), (3, "default"), (4, "default"), (None, "default")]
    with pytest.raises(FAILURES, match="more than once: 1"):
        joins.scalar_backfill(frame, lookup.union(lookup), "k", {"c": "default"}).collect()


def test_sets(spark):
    left = spark.createDataFrame([(1, "a")], "k int, v string")
    right = spark.createDataFrame([("a", 1)], "v string, k int")
    assert rows(sets.union_all([left, right])) == [(1, "a"), (1, "a")]
    assert rows(sets.duplicated_keys(sets.union_all([left, right]), ["k", "v"])) == [(1, "a", 2)]
    both = sets.consolidate({"l": left, "r": right.drop("v")})
    assert both.columns == ["k", "v", "source_table"]
    assert rows(both) == [(1, "a", "l"), (1, None, "r")]


def test_layout_keeps_all_rows(spark, tmp_path):
    frame = spark.range(1000).selectExpr("if(id % 3 = 0, -1, id % 7) as k", "id")
    expected = rows(frame)
    assert rows(layout.partition_by_key(frame, ["k"])) == expected
    assert rows(layout.partition_by_key(frame, ["k"], 4)) == expected
    assert rows(layout.partition_by_key(frame, ["k"], split_hot=False)) == expected
    whole = layout.partition_by_key(frame, ["k"], 4, split_hot=False)
    placed = whole.withColumn("p", F.spark_partition_id())
    spread = placed.groupBy("k").agg(F.count_distinct("p").alias("n"))
    assert {r["n"] for r in spread.collect()} == {1}
    stored = layout.clustered_rewrite(frame, str(tmp_path / "c"), ["k", "id"])
    assert rows(stored) == expected


def test_clustered_files_hold_separate_ranges(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(10_000).selectExpr("cast(rand(3) * 1000 as int) as k", "id")
        layout.clustered_rewrite(frame, str(tmp_path / "c"), ["k", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(str(tmp_path / "c")).withColumn("f", F.input_file_name())
    spans = sorted(
        (r["low"], r["high"])
        for r in stored.groupBy("f").agg(F.min(F.struct("k", "id")).alias("low"), F.max(F.struct("k", "id")).alias("high")).collect()
    )
    assert len(spans) > 1
    assert all(left[1] < right[0] for left, right in zip(spans, spans[1:]))


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_cleansing(spark):
    text = F.lit
    cases = {"": "UNKNOWN", "WEST COAST": "WEST COAST", "West Coast": "W C", "N0RTH-1": "NRTH", " ": " "}
    for region, cleaned in cases.items():
        assert value(spark, cleansing.clean_region(text(region))) == cleaned
    assert value(spark, cleansing.clean_region(text(None).cast("string"))) is None
    dates = {"2024-01-15": "2024-01-15", "invalid": None, "2024-1-5": None, "2024-01-15 ": None}
    for shown, kept in dates.items():
        assert value(spark, cleansing.iso_date_text(text(shown))) == kept
    amounts = {"-0.01": None, "0": 0, "999999.99": 999999.99, "1000000": None, "1.005": 1.01}
    for amount, kept in amounts.items():
        out = value(spark, cleansing.bounded_round(text(amount).cast("decimal(12,3)")))
        assert (None if out is None else float(out)) == kept
    assert value(spark, cleansing.upper_trim(text(" a b "))) == "A B"
    assert value(spark, cleansing.upper_trim(text(None).cast("string"))) == "UNKNOWN"
    assert value(spark, cleansing.upper_trim(text(None).cast("string"), None)) is None
    for status, code in {"ACTIVE": "A", "INACTIVE": "I", "PENDING": "P", "X": "U", None: "U"}.items():
        assert value(spark, cleansing.map_status(text(status).cast("string"))) == code
    day = F.lit("2024-01-01").cast("date")
    assert value(spark, cleansing.retention_date(day)) == dt.date(2030, 12, 30)
    assert value(spark, cleansing.retention_date(day, months=84)) == dt.date(2031, 1, 1)


def test_ratios(spark):
    for top, bottom, ratio in [(1, 4, 0.25), (1, 0, 0.0), (1, None, 0.0), (1, -1, 0.0), (None, 2, None)]:
        quotient = measures.safe_ratio(F.lit(top).cast("int"), F.lit(bottom).cast("int"))
        assert value(spark, quotient) == ratio


def test_checksums_and_masks(spark):
    import hashlib

    frame = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "i int, x string, y string")
    plain = [r[0] for r in frame.select(protection.checksum_md5(["i", "x", "y"])).collect()]
    assert plain == [hashlib.md5(b"1|a").hexdigest()] * 2
    apart = [r[0] for r in frame.select(protection.checksum_md5(["i", "x", "y"], null_token="~")).collect()]
    assert apart == [hashlib.md5(t).hexdigest() for t in (b"1|~|a", b"1|a|~")]
    assert value(spark, protection.mask_hash(F.lit(12))) == hashlib.sha256(b"12").hexdigest()
    assert value(spark, protection.mask_partial(F.lit("x"))) == "x***"
    assert value(spark, protection.mask_prefix4(F.lit("abcdef"))) == "abcd****"
    assert value(spark, protection.mask_partial(F.lit(None).cast("string"))) is None
    key = F.lit("0123456789abcdef")
    names = spark.range(50).selectExpr("concat('secret', id % 2) as s")
    cipher = names.select("s", protection.encrypt("s", key).alias("c"))
    stored = cipher.collect()
    assert len({r["c"] for r in stored}) == 50
    back = spark.createDataFrame(stored).select("s", protection.decrypt("c", key)).collect()
    assert all(r[0] == r[1] for r in back)
