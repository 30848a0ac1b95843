"""Stored histories and upserts: what is written, what is read, runs that fail or run again; key digests."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyline.operators import digests, history, reconciliation
from tallyline.plans import amendments
from tallyline.sources import keyed
from tests.plans import at_scale, planned

START = dt.datetime(2024, 1, 1)
END = dt.datetime(9999, 12, 31, 23, 59, 59)
VERSION = "business_key long, effective_start_date timestamp_ntz, value string, change_hash string"
LEFT = "business_key long, effective_start_date timestamp_ntz"


def batch(spark, rows):
    return spark.createDataFrame([(k, START + dt.timedelta(d), v, v) for k, d, v in rows], VERSION)


def departures(spark, rows):
    return spark.createDataFrame([(k, START + dt.timedelta(d)) for k, d in rows], LEFT)


def state(df):
    rows = df.select("business_key", "effective_start_date", "effective_end_date", "value", "is_current").collect()
    return sorted(map(tuple, rows), key=str)


def files(path):
    return {p: (p.stat().st_mtime_ns, p.stat().st_size) for p in path.rglob("*.parquet")}


def plain(batches):
    """Histories from lists of events: a batch is ([(key, day, value)], [(key, day)])."""
    known = {}
    for versions, left in batches:
        fresh = {}
        for k, d, v in versions:
            fresh.setdefault(k, []).append((d, 1, 1, v))
        for k, d in left:
            fresh.setdefault(k, []).append((d, 1, 0, ""))
        for k, events in fresh.items():
            line = sorted([(d, 0, g, v) for d, g, v in known.get(k, [])] + events)
            kept, before = [], None
            for d, new, there, v in line:
                now = (there, v)
                if (new or not there) and (now == before or (before is None and not there)):
                    before = now
                    continue
                kept.append((d, there, v))
                before = now
            known[k] = kept
    rows = []
    for k, line in known.items():
        for n, (d, there, v) in enumerate(line):
            if there:
                last = n == len(line) - 1
                end = END if last else START + dt.timedelta(line[n + 1][0])
                rows.append((k, START + dt.timedelta(d), end, v, last))
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_stored_and_plain_histories_agree(spark, tmp_path, seed, monkeypatch):
    """Batches on time, late, again, with departures and returns, NULL among the keys."""
    monkeypatch.setattr(keyed, "COMPACT_AT", 0.5)
    rng = random.Random(seed)
    keys = [None, *range(30)]
    batches, day = [], 0
    for _ in range(6):
        late = rng.random() < 0.4
        days = lambda: rng.choice(range(0, day + 1)) if late and day else day + rng.randint(1, 4)
        chosen = rng.sample(keys, 12)
        when = {k: days() for k in chosen}
        versions = [(k, when[k], rng.choice("abc")) for k in chosen[:8]] + [(chosen[0], when[chosen[0]] + 5, "z")]
        batches.append((versions, [(k, when[k]) for k in chosen[8:]]))
        day += 5
    batches.append(batches[-1])
    merged = history.first_versions(batch(spark, [])).filter("false")
    for n, (versions, left) in enumerate(batches):
        stored = history.merge_stored(
            batch(spark, versions), str(tmp_path / "h"), str(tmp_path / f"s{n}"), buckets=3, departed=departures(spark, left)
        )
        assert state(stored) == plain(batches[: n + 1])
        merged = spark.createDataFrame(merged.collect(), merged.schema)
        merged = history.scd2_merge(merged, batch(spark, versions), departures(spark, left))
        assert state(merged) == plain(batches[: n + 1])
        assert not (tmp_path / f"s{n}").exists()


def test_a_small_batch_writes_little(spark, tmp_path):
    path, n = str(tmp_path / "h"), 20_000
    rows = spark.range(n).selectExpr(
        "id as business_key", "timestamp_ntz'2024-01-01' as effective_start_date",
        "sha2(string(id), 512) as value", "md5(string(id)) as change_hash",
    )
    history.merge_stored(rows, path, str(tmp_path / "s0"))
    before = files(tmp_path / "h")
    total = sum(size for _, size in before.values())
    changed = rows.filter("business_key % 100 = 7").withColumns(
        {"effective_start_date": F.expr("timestamp_ntz'2024-02-01'"), "change_hash": F.lit("new")}
    )
    merged = history.merge_stored(changed, path, str(tmp_path / "s1"))
    assert merged.count() == n + n // 100 and merged.filter("is_current").count() == n
    after = files(tmp_path / "h")
    assert {p: after[p] for p in before} == before
    assert sum(size for p, (_, size) in after.items() if p not in before) < 0.05 * total
    again = history.merge_stored(changed, path, str(tmp_path / "s2"))
    assert files(tmp_path / "h") == after and again.count() == merged.count()


def test_closed_rows_are_not_read_by_batches_on_time(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    history.merge_stored(batch(spark, [(1, 0, "a"), (2, 0, "a")]), path, str(tmp_path / "s0"))
    history.merge_stored(batch(spark, [(1, 3, "b")]), path, str(tmp_path / "s1"))
    read = []
    real = history.closed_rows
    monkeypatch.setattr(history, "closed_rows", lambda *a: read.append(1) or real(*a))
    monkeypatch.setattr(history, "read_stored", lambda *a: None)
    history.merge_stored(batch(spark, [(1, 5, "c"), (3, 5, "c")]), path, str(tmp_path / "s2"))
    assert not read
    history.merge_stored(batch(spark, [(1, 1, "late")]), path, str(tmp_path / "s3"))
    assert read


def test_a_run_that_fails_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    before = state(history.merge_stored(batch(spark, [(1, 0, "a"), (2, 0, "a")]), path, str(tmp_path / "s0")))
    second = batch(spark, [(1, 2, "b"), (2, 2, "b")])

    def died(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(keyed, "finish", died)
        with pytest.raises(RuntimeError, match="died"):
            history.merge_stored(second, path, str(tmp_path / "s1"))
    schema = history.first_versions(second).schema
    assert state(history.read_stored(spark, path, schema)) == before
    # another batch takes its number, and nothing of the failed one stays
    third = history.merge_stored(batch(spark, [(3, 2, "c")]), path, str(tmp_path / "s2"))
    assert state(third) == plain([([(1, 0, "a"), (2, 0, "a")], []), ([(3, 2, "c")], [])])
    with pytest.raises(FileExistsError):
        keyed.finish(spark, path, keyed.Run(2, 0))


def test_a_new_base_replaces_changes(spark, tmp_path):
    path = str(tmp_path / "h")
    done = [([(k, 0, "a") for k in range(20)], [(3, 0)])]
    for n in range(1, 5):
        done.append(([(k, n, f"v{n}") for k in range(20)], [(n, n + 1)]))
    for n, (versions, left) in enumerate(done):
        found = history.merge_stored(
            batch(spark, versions), path, str(tmp_path / f"s{n}"), buckets=2, departed=departures(spark, left)
        )
        assert state(found) == plain(done[: n + 1])
    bases = [r for r in keyed.runs(spark, path) if r.buckets]
    assert len(bases) > 2
    kept = {p.name for p in (tmp_path / "h" / "base").iterdir()}
    assert kept == {f"run={r.number:08d}" for r in bases[-2:]}


EVENT = "event_id string, ingest_ts string, kafka_offset long, payload string"


def test_stored_upsert(spark, tmp_path):
    path, steps = str(tmp_path / "t"), iter(range(100))

    def upsert(rows, deleted=None):
        found = amendments.upsert_stored(
            spark.createDataFrame(rows, EVENT), path, str(tmp_path / f"s{next(steps)}"), deleted=deleted, buckets=4
        )
        return sorted(map(tuple, found.collect()), key=str)

    first = [(f"e{k}", "t1", k, "a") for k in range(40)] + [(None, "t1", 99, "none")]
    assert upsert(first) == sorted(first, key=str)
    before = files(tmp_path / "t")
    second = [("e1", "t2", 1, "b"), ("e2", "t0", 2, "older"), (None, "t2", 1, "nn"), ("new", "t1", 1, "n")]
    expected = sorted([r for r in first if r[0] not in ("e1", None)] + [second[0], second[2], second[3]], key=str)
    assert upsert(second) == expected
    after = files(tmp_path / "t")
    assert {p: after[p] for p in before} == before and len(after) > len(before)
    assert upsert(second) == expected and files(tmp_path / "t") == after
    gone = [("e1", "t3", 1, None), ("e7", "t1", 7, None), ("never", "t3", 0, None)]
    without = [r for r in expected if r[0] != "e1"]
    assert upsert(gone, F.col("ingest_ts") == "t3") == without
    # older rows do not come back
    assert upsert([("e1", "t2", 5, "x"), ("never", "t2", 5, "x")]) == without
    assert upsert([("e1", "t4", 0, "back")]) == sorted([*without, ("e1", "t4", 0, "back")], key=str)


def test_departures_in_memory(spark):
    first = history.first_versions(batch(spark, [(1, 0, "a"), (None, 0, "n")]))
    left = history.scd2_merge(first, batch(spark, []), departures(spark, [(1, 4), (9, 4)]))
    day = [START + dt.timedelta(d) for d in range(8)]
    assert state(left) == [(1, day[0], day[4], "a", False), (None, day[0], END, "n", True)]
    back = history.scd2_merge(left, batch(spark, [(1, 6, "a"), (None, 1, "n")]))
    assert state(back) == [(1, day[0], day[4], "a", False), (1, day[6], END, "a", True), (None, day[0], END, "n", True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_differing_keys(spark, seed):
    rng = random.Random(seed)
    left = [rng.choice([None, *range(400)]) for _ in range(600)]
    right = [k for k in left if rng.random() > 0.02] + [rng.choice(range(380, 420)) for _ in range(5)]
    frames = [spark.createDataFrame([(k,) for k in keys], "k int") for keys in (left, right)]
    frames[1] = frames[1].withColumn("k", F.col("k").cast("long"))
    a, b = Counter(left), Counter(right)
    expected = sorted(((k, a[k], b[k]) for k in {*a, *b} if a[k] != b[k]), key=str)
    for levels in ((256, 256), (2, 3)):
        found = digests.differing_keys(*frames, "k", levels=levels).collect()
        assert sorted(map(tuple, found), key=str) == expected
    gone = digests.only_left(*frames, "k").collect()
    assert {r[0] for r in gone} == {k for k in a if not b[k]}
    report = reconciliation.reconcile_by_digest(*frames, "k", F.col("k") > 10)
    assert report.collect() == reconciliation.reconcile(*frames, "k", F.col("k") > 10).collect()


def test_equal_and_empty_tables(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    assert digests.differing_keys(rows, rows.repartition(7), "k").collect() == []
    assert digests.differing_keys(rows.limit(0), rows.limit(0), "k").collect() == []
    assert digests.differing_keys(rows, rows.limit(0), "k").count() == 1000
    report = reconciliation.reconcile_by_digest(rows.limit(0), rows.limit(0), "k", F.lit(True))
    assert report.collect() == reconciliation.reconcile(rows.limit(0), rows.limit(0), "k", F.lit(True)).collect()


def test_only_differing_partitions_are_read_again(spark, tmp_path):
    rows = spark.range(5000).withColumnRenamed("id", "k").withColumn("part", keyed.key_bucket("k", 32))
    for name, kept in (("a", rows), ("b", rows.filter("k <> 1234"))):
        kept.write.partitionBy("part").parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    found = digests.differing_keys(a, b, "k", bucket="part")
    assert [tuple(r) for r in found.collect()] == [(1234, 1, 0)]
    part = rows.filter("k = 1234").first()["part"]
    pruned = [line for line in planned(found).splitlines() if "FileScan" in line]
    assert pruned
    assert all(f"(part#" in line and f"= {part})" in line.split("PartitionFilters")[1] for line in pruned)


def test_a_merge_moves_rows_once_and_packed(spark):
    """One exchange whatever the sizes; hashes of any form, surrogate keys of others and keys not named stay as they are."""
    odd = ["AB12", "0a1", "zz", "", None, "ab12"]
    rows = spark.createDataFrame([(k, START, f"v{k}", h) for k, h in enumerate(odd)] + [(None, START, "n", "00")], VERSION)
    old = history.first_versions(rows).withColumn(
        history.SURROGATE, F.expr("CASE business_key WHEN 1 THEN 'mine' WHEN 2 THEN NULL ELSE surrogate_key END")
    )
    # no open row and an end of its own, but not in the batch
    lone = history.first_versions(batch(spark, [(70, 1, "x")])).withColumns(
        {"is_current": F.lit(None).cast("boolean"), "effective_end_date": F.lit(None).cast("timestamp_ntz")}
    )
    old = old.unionByName(lone)
    old = spark.createDataFrame(old.collect(), old.schema)
    merged = history.scd2_merge(old, batch(spark, [(0, 5, "ff00")]))
    found = {(r.business_key, r.change_hash): r for r in merged.collect()}
    before = {(r.business_key, r.change_hash): r for r in old.collect()}
    fresh = found.pop((0, "ff00"))
    assert fresh.surrogate_key == history.first_versions(batch(spark, [(0, 5, "ff00")])).first().surrogate_key
    closed, was = found.pop((0, "AB12")), before.pop((0, "AB12"))
    assert closed.surrogate_key == was.surrogate_key and not closed.is_current
    assert found == before

    with at_scale(spark):
        plan = planned(history.scd2_merge(old, batch(spark, [(0, 5, "ff00")]), departures(spark, [(1, 4)])))
    assert plan.count("Exchange hashpartitioning") == 1


def test_keys_are_dealt_out_once(spark):
    """Keys that repeat, and NULL, find and leave out rows without an aggregate of their own."""
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    keys = spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "k long")
    with at_scale(spark):
        for how, expected in (("left_semi", ["a", "n"]), ("left_anti", ["b"])):
            found = keyed.of_keys(rows, keys, "k", how)
            plan = planned(found)
            assert plan.count("Exchange hashpartitioning") == 2 and "Aggregate" not in plan
            assert sorted(r.v for r in found.collect()) == expected


def test_stored_rows_are_small(spark, tmp_path):
    """All files of heads, changes and closed rows are written with zstd."""
    path = tmp_path / "h"
    for n, value in enumerate("ab"):
        history.merge_stored(batch(spark, [(1, n, value), (2, 0, "a")]), str(path), str(tmp_path / f"s{n}"))
    assert {p.suffixes[-2] for p in files(path)} == {".zstd"}
    assert files(path / "closed")
