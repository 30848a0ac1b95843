"""Clustered files, clusters that do not depend on the layout, days of late events, keyed masks, timed steps."""

import datetime as dt
import hashlib
import hmac
import random
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyline.functions import protection
from tallyline.operators import clustering, governance, layout, monitoring
from tallyline.plans import domain, engagement
from tallyline.sources import writers

FOLDER = "/root/testdata/sf0.001"


def files_met(path, column, low, high):
    """How many of the files have a range of the column that meets [low, high], and how many there are."""
    met, files = 0, sorted(path.rglob("*.parquet"))
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        met += any(s.min <= high and s.max >= low for s in stats)
    return met, len(files)


def test_filters_on_either_column_skip_files(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "id", "cast(pmod(xxhash64(id), 9000) as int) as a",
        "cast(timestamp_seconds(1700000000 + pmod(xxhash64(id, 1), 100000) * pmod(xxhash64(id, 2), 3)) as timestamp_ntz) as b",
        "concat('k', pmod(xxhash64(id, 3), 500)) as c",
    ).repartition(4)
    rows.write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    out = layout.morton_rewrite(stored, str(tmp_path / "out"), ["a", "b"], num_partitions=64)
    assert sorted(out.columns) == sorted(rows.columns) and out.exceptAll(stored).isEmpty() and out.count() == 40_000
    for column, low, high in (("a", 4000, 4100), ("a", 0, 5)):
        met, n = files_met(tmp_path / "out", column, low, high)
        assert n >= 24 and met < n / 2
    at = dt.datetime(2023, 11, 15, 6)
    met, n = files_met(tmp_path / "out", "b", at, at + dt.timedelta(minutes=5))
    assert met < n / 2
    layout.morton_rewrite(stored, str(tmp_path / "text"), ["c", "a"], num_partitions=64)
    for column, low, high in (("c", "k250", "k255"), ("a", 4000, 4100)):
        met, n = files_met(tmp_path / "text", column, low, high)
        assert met < n / 2


def test_codes_interleave_ranks(spark):
    rows = [(x, float(y)) for x in range(64) for y in range(64)] + [(None, None)]
    frame = spark.createDataFrame(rows, "x int, y double")
    code = layout.morton_code(frame, ["x", "y"], bits=3)
    found = {(r["x"], r["y"]): r["code"] for r in frame.withColumn("code", code).collect()}
    rank = {"x": {}, "y": {}}
    for (x, y), c in found.items():
        if x is not None:
            bits = [(c >> k) & 1 for k in range(6)]
            for name, value, at in (("x", x, 1), ("y", y, 0)):
                rank[name].setdefault(value, set()).add(sum(bits[2 * k + at] << k for k in range(3)))
    for ranks in rank.values():
        # a rank depends on the column's value alone, grows with it, and takes all eight numbers
        assert all(len(r) == 1 for r in ranks.values())
        line = [min(ranks[v]) for v in sorted(ranks)]
        assert line == sorted(line) and set(line) == set(range(8))
    assert found[None, None] == 0
    with pytest.raises(ValueError, match="no order"):
        layout.morton_code(frame.withColumn("z", F.array("x")), ["z"])


def test_centers_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(c, 2.0, (200, 2)) for c in ((0, 0), (40, 5), (10, 60))])
    rows = [(float(x), float(y)) for x, y in points] + [(None, 3.0)]
    frame = spark.createDataFrame(rows, "x double, y double")
    one = clustering.fit_centers(frame.coalesce(1), ["x", "y"], 3, 5)
    random.Random(1).shuffle(rows)
    seven = clustering.fit_centers(spark.createDataFrame(rows, "x double, y double").repartition(7), ["x", "y"], 3, 5)
    assert one == seven
    near = sorted(min(np.hypot(a - x, b - y) for a, b in one) for x, y in ((0, 0), (40, 5), (10, 60)))
    assert near[-1] < 1
    assert clustering.first_centers(frame, ["x", "y"], 3, 5) != clustering.first_centers(frame, ["x", "y"], 3, 6)
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    assert clustering.fit_centers(same, ["x", "y"], 3, 1) == [[1.0, 2.0]]
    empty, centers = clustering.clustered(same.limit(0), ["x", "y"], 3, 1)
    assert centers == [] and empty.count() == 0


def test_a_late_event_changes_its_day_only(spark, tmp_path):
    tiles, interstitials = domain.tile_events(spark, FOLDER), domain.interstitial_events(spark, FOLDER)
    tiles, interstitials = (e.withColumn("arrived", F.col("event_ts")) for e in (tiles, interstitials))
    first = engagement.run_arrivals(tiles, interstitials, str(tmp_path), "arrived")
    days = [r["date"] for r in first.kpis.select("date").orderBy("date").collect()]
    for day in days[:2]:
        expected = engagement.daily_summary(tiles, interstitials, day)
        found = first.daily.filter(F.col("date") == day).select(expected.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))

    def files():
        return {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}

    before = files()
    bound = F.lit("2031-01-01").cast("timestamp")
    assert engagement.run_arrivals(tiles, interstitials, str(tmp_path), "arrived", bound) is None
    late = tiles.filter(F.to_date("event_ts") == F.lit(days[1])).limit(1)
    late = late.withColumns({"arrived": bound, "tile_id": F.lit("LATE"), "event_type": F.lit("TILE_VIEW")})
    again = engagement.run_arrivals(tiles.unionByName(late), interstitials, str(tmp_path), "arrived", bound)
    assert [r["date"] for r in again.daily.filter("tile_id = 'LATE'").collect()] == [days[1]]
    after = files()
    changed = {p.parent.name for p in {*before, *after} if before.get(p) != after.get(p)}
    assert changed == {f"date={days[1]}"}


def test_several_days_are_replaced_and_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2024, 1, k) for k in range(1, 6)]
    rows = spark.createDataFrame([(d, 1) for d in days], "day date, run int")
    writers.write_path(rows, path, partition_by=["day"])
    new = spark.createDataFrame([(days[0], 2), (days[3], 2), (days[4], 2)], "day date, run int")
    found = writers.replace_partitions(new, path, "day", [days[0], days[1], days[3]])
    assert sorted((r["day"].day, r["run"]) for r in found.collect()) == [(1, 2), (3, 1), (4, 2), (5, 1)]
    assert writers.replace_partitions(new, path, "day", []).count() == 4


def test_keyed_masks(spark):
    texts = ["", "a", "ü" * 100, None, "12"]
    frame = spark.createDataFrame([(t,) for t in texts], "v string")
    for secret in (b"k", b"x" * 64, b"y" * 200):
        key = protection.MaskKey("one", secret)
        found = [r[0] for r in frame.select(protection.mask_hmac("v", key)).collect()]
        expected = [t if t is None else "one:" + hmac.new(secret, t.encode(), hashlib.sha256).hexdigest() for t in texts]
        assert found == expected
    old, new = protection.MaskKey("one", b"y" * 200), protection.MaskKey("two", b"z")
    masked = frame.withColumn("m", protection.mask_hmac("v", old))
    same = [r[0] for r in masked.select(protection.mask_matches("v", "m", [new, old])).collect()]
    assert same == [True, True, True, None, True]
    other = masked.select(protection.mask_matches(F.concat("v", F.lit("!")), "m", [old, new])).collect()
    assert [r[0] for r in other] == [False, False, False, None, False]
    assert [r[0] for r in masked.select(protection.mask_matches("v", "m", [new])).collect()] == [None] * 5
    columns = governance.mask_columns(frame, {"v": "HMAC", "w": "HASH"}, new)
    assert columns.filter("v like 'two:%'").count() == 4
    with pytest.raises(ValueError, match="needs a key"):
        governance.mask_columns(frame, {"v": "HMAC"})


def test_each_step_has_its_own_time(spark, tmp_path):
    steps = monitoring.TimedSteps(spark, str(tmp_path))
    quick = steps.store(spark.range(10), "quick")

    def slow(batches):
        time.sleep(1.5)
        yield from batches

    steps.store(quick.coalesce(1).mapInArrow(slow, "id long").filter("id < 4"), "slow, with a comma")
    found = {r["step_name"]: r for r in steps.frame(dt.datetime(2024, 1, 1)).collect()}
    assert found["quick"]["row_count"] == 10 and found["slow, with a comma"]["row_count"] == 4
    assert found["slow, with a comma"]["duration_seconds"] > 1.5 and found["slow, with a comma"]["partition_count"] == 1
    rates = {r["step_name"]: r["rows_per_second"] for r in monitoring.throughput(steps.frame()).collect()}
    assert rates["slow, with a comma"] < 4 / 1.5
