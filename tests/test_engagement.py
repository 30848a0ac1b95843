"""Daily engagement on hand-counted rows."""

import datetime as dt

import pytest

from tallyline import schemas
from tallyline.plans import engagement

DAY = "2024-03-10"


@pytest.fixture
def tiles(spark):
    rows = [
        ("u1", "A", "TILE_VIEW", "2024-03-10 00:00:00"),
        ("u1", "A", "TILE_VIEW", "2024-03-10 23:59:59.999999"),
        ("u2", "A", "TILE_VIEW", "2024-03-10 12:00:00"),
        ("u1", "A", "TILE_CLICK", "2024-03-10 12:00:00"),
        ("u1", "B", "TILE_VIEW", "2024-03-10 12:00:00"),
        (None, "B", "TILE_CLICK", "2024-03-10 12:00:00"),
        ("u3", None, "TILE_VIEW", "2024-03-10 12:00:00"),
        ("u3", "C", None, "2024-03-10 12:00:00"),
        ("u4", "A", "TILE_VIEW", "2024-03-09 23:59:59"),
        ("u4", "A", "TILE_VIEW", "2024-03-11 00:00:00"),
    ]
    return spark.createDataFrame(rows, "user_id string, tile_id string, event_type string, ts string").selectExpr(
        "user_id", "tile_id", "event_type", "cast(ts as timestamp) as event_ts"
    )


@pytest.fixture
def interstitials(spark):
    rows = [
        ("u1", "A", True, False, None),
        ("u2", "A", None, True, False),
        ("u2", "A", True, True, True),
        ("u9", "D", True, None, True),
        ("u9", None, True, False, False),
    ]
    kind = (
        "user_id string, tile_id string, interstitial_view_flag boolean, "
        "primary_button_click_flag boolean, secondary_button_click_flag boolean"
    )
    return spark.createDataFrame(rows, kind).selectExpr(
        "*", f"cast('{DAY} 08:00:00' as timestamp) as event_ts"
    )


EXPECTED = {
    ("A", 2, 1, 2, 1, 1),
    ("B", 1, 0, 0, 0, 0),
    ("C", 0, 0, 0, 0, 0),
    ("D", 0, 0, 1, 0, 1),
    (None, 1, 0, 0, 0, 0),
    (None, 0, 0, 1, 0, 0),
}


def test_daily_summary(tiles, interstitials):
    rows = engagement.daily_summary(tiles, interstitials, DAY).collect()
    assert {tuple(r)[1:] for r in rows} == EXPECTED
    assert {r["date"] for r in rows} == {dt.date(2024, 3, 10)}


def test_global_kpis_count_a_user_once_per_tile(tiles, interstitials):
    row = engagement.global_kpis(engagement.daily_summary(tiles, interstitials, DAY)).first()
    assert tuple(row)[1:6] == (4, 1, 4, 1, 2)
    assert tuple(row)[6:] == (1 / 4, 1 / 4, 2 / 4)


def test_rates_of_an_empty_side_are_zero(tiles, interstitials):
    summary = engagement.daily_summary(tiles.filter("false"), interstitials.filter("false"), DAY)
    assert engagement.global_kpis(summary).collect() == []
    only_interstitials = engagement.daily_summary(tiles.filter("false"), interstitials, DAY)
    assert engagement.global_kpis(only_interstitials).first()["overall_ctr"] == 0.0


@pytest.fixture
def metadata(spark):
    rows = [
        ("A", "x", "FINANCE", True, "2024-01-01"),
        ("A", "x", "HEALTH", True, "2024-02-01"),
        ("B", "y", "HEALTH", False, "2024-01-01"),
        ("D", "z", "HEALTH", True, "2024-01-01"),
    ]
    return spark.createDataFrame(
        rows, "tile_id string, tile_name string, tile_category string, is_active boolean, ts string"
    ).selectExpr("*", "cast(ts as timestamp) as updated_ts")


def test_categories(tiles, interstitials, metadata):
    summary = engagement.daily_summary(tiles, interstitials, DAY)
    enriched = engagement.with_category(summary, metadata)
    assert enriched.columns == schemas.schema("tile_daily_summary").fieldNames()
    assert enriched.count() == summary.count()
    found = {(r["tile_id"], r["tile_category"]) for r in enriched.collect()}
    assert found == {("A", "HEALTH"), ("B", "UNKNOWN"), ("C", "UNKNOWN"), ("D", "HEALTH"), (None, "UNKNOWN")}
    rollup = {r["tile_category"]: r for r in engagement.category_rollup(enriched).collect()}
    assert rollup["HEALTH"]["tile_count"] == 2
    assert rollup["HEALTH"]["total_tile_views"] == 2
    assert rollup["HEALTH"]["overall_ctr"] == 0.5
    counted = engagement.category_distribution(enriched, DAY).collect()
    assert {tuple(r) for r in counted} == {("HEALTH", 2), ("UNKNOWN", 4)}
    assert engagement.category_distribution(enriched, "2024-03-11").count() == 0


def test_distinct_users_equal_count_distinct(spark):
    from pyspark.sql import functions as F

    events = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('t', id % 40)) as tile_id",
        "if(id % 17 = 0, null, concat('u', hash(id) % 90)) as user_id",
        "elt(cast(id % 4 as int) + 1, 'TILE_VIEW', 'TILE_CLICK', 'OTHER', null) as event_type",
    )
    ours = engagement.tile_counts(events)
    plain = events.groupBy("tile_id").agg(
        F.countDistinct(F.when(F.col("event_type") == "TILE_VIEW", F.col("user_id"))).alias("v"),
        F.countDistinct(F.when(F.col("event_type") == "TILE_CLICK", F.col("user_id"))).alias("c"),
    )
    assert {tuple(r) for r in ours.collect()} == {tuple(r) for r in plain.collect()}
