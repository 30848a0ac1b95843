"""The jobs as a whole: written twice, failing checks, outputs read back."""

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import history
from tallyline.plans import amendments, domain, engagement, increment, regulatory
from tallyline.sources.readers import scan_path, scan_pipe_csv

FOLDER = "/root/testdata/sf0.001"
DAYS = ("2024-01-04", "2024-01-05")


def rows(df):
    return sorted(map(str, df.collect()))


def run_regulatory(spark, folder, transactions=None):
    return regulatory.run_reports(
        domain.customers(spark, FOLDER),
        domain.accounts(spark, FOLDER),
        domain.transactions(spark, FOLDER) if transactions is None else transactions,
        domain.branches(spark, FOLDER),
        domain.branch_details(spark, FOLDER),
        folder,
    )


def test_regulatory_job_can_run_again(spark, tmp_path):
    first = run_regulatory(spark, str(tmp_path))
    before = rows(first.branch_summary), rows(first.customer_transactions)
    again = run_regulatory(spark, str(tmp_path))
    assert (rows(again.branch_summary), rows(again.customer_transactions)) == before
    assert again.branch_summary.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.schema("branch_summary_report")
    ]


def test_regulatory_job_fails_on_bad_totals(spark, tmp_path):
    owed = domain.transactions(spark, FOLDER).withColumn("AMOUNT", -F.col("AMOUNT"))
    with pytest.raises(ValueError, match="check failed.*BRANCH_SUMMARY_REPORT"):
        run_regulatory(spark, str(tmp_path), owed)
    with pytest.raises(ValueError, match="AML_CUSTOMER_TRANSACTIONS"):
        run_regulatory(spark, str(tmp_path), owed.filter("false"))


def test_engagement_job_replaces_one_day(spark, tmp_path):
    tiles, interstitials = domain.tile_events(spark, FOLDER), domain.interstitial_events(spark, FOLDER)
    for day in (*DAYS, DAYS[0]):
        written = engagement.run_day(tiles, interstitials, str(tmp_path), day)
    assert written.kpis.count() == 2
    for day in DAYS:
        expected = engagement.daily_summary(tiles, interstitials, day)
        stored = written.daily.filter(F.col("date") == day).select(expected.columns)
        assert rows(stored) == rows(expected)
        kpis = engagement.global_kpis(expected)
        assert rows(written.kpis.filter(F.col("date") == day).select(kpis.columns)) == rows(kpis)


def test_a_failed_run_leaves_the_last_reports(spark, tmp_path):
    good = run_regulatory(spark, str(tmp_path))
    before = rows(good.branch_summary), rows(good.customer_transactions)
    owed = domain.transactions(spark, FOLDER).withColumn("AMOUNT", -F.col("AMOUNT"))
    with pytest.raises(ValueError, match="check failed"):
        run_regulatory(spark, str(tmp_path), owed)
    stored = [scan_path(spark, str(tmp_path / name)) for name in ("branch_summary_report", "aml_customer_transactions")]
    assert (rows(stored[0]), rows(stored[1])) == before


def test_a_batch_below_the_minimum_leaves_the_last_tables(spark, tmp_path):
    landing, template = domain.landing(spark, FOLDER), domain.template(spark)
    stamp = F.lit("2026-01-15 00:00:00").cast("timestamp")
    before = rows(amendments.run_batch(landing, template, str(tmp_path), processing_ts=stamp))
    with pytest.raises(Exception, match="insufficient input records"):
        amendments.run_batch(landing.filter("false"), template, str(tmp_path), processing_ts=stamp)
    assert rows(scan_path(spark, str(tmp_path / "assessed")).select("event_id")) == rows(
        scan_path(spark, str(tmp_path / "raw")).select("event_id")
    )
    assert len(before) == scan_path(spark, str(tmp_path / "raw")).count()


def test_days_without_metadata_keep_a_category_column(spark, tmp_path):
    tiles, interstitials = domain.tile_events(spark, FOLDER), domain.interstitial_events(spark, FOLDER)
    engagement.run_day(tiles, interstitials, str(tmp_path), DAYS[0])
    metadata = domain.tile_metadata(spark, FOLDER)
    written = engagement.run_day(tiles, interstitials, str(tmp_path), DAYS[1], metadata)
    by_day = {r["date"].isoformat(): r for r in written.daily.groupBy("date").agg(F.count("*").alias("n"), F.count("tile_category").alias("named")).collect()}
    assert by_day[DAYS[0]]["named"] == 0 and by_day[DAYS[0]]["n"] > 0
    assert by_day[DAYS[1]]["named"] == by_day[DAYS[1]]["n"]
    again = engagement.run_day(tiles, interstitials, str(tmp_path), DAYS[0])
    assert "tile_category" in again.daily.columns


def test_increment_job(spark, tmp_path):
    def run(batch, records, threshold=0.8, since=None):
        return increment.run_increment(
            records,
            domain.table(spark, FOLDER, "orders"),
            "o_orderkey",
            str(tmp_path),
            "orders",
            batch,
            "secret",
            since=since,
            masks={"column2": "HASH"},
            now=F.lit("2026-01-15").cast("timestamp_ntz"),
            threshold=threshold,
        )

    records = domain.source_records(spark, FOLDER)
    first = run("B1", records)
    wanted = records.filter("status in ('ACTIVE', 'PENDING')").count()
    assert first.history.count() == wanted and first.lineage.count() == wanted
    mark = first.watermark.first()
    assert mark["last_processed_date"] is not None and mark["table_name"] == "orders"

    before = rows(first.history)
    start = F.lit("1990-01-01").cast("timestamp_ntz")
    for _ in range(2):
        same = run("B2", records, since=start)
        assert rows(same.history) == before
        assert same.lineage.count() == 2 * wanted

    changed = run("B3", domain.record_changes(spark, FOLDER), since=start)
    pending = records.filter("status = 'PENDING'").count()
    assert changed.history.count() == wanted + pending
    assert changed.history.filter("is_current").count() == wanted
    assert changed.history.select("surrogate_key").distinct().count() == wanted + pending
    after = rows(changed.history)

    with pytest.raises(ValueError, match="check failed"):
        run("B4", records, threshold=0.95, since=start)
    later = run("B5", records.filter("id < 0"))
    assert rows(later.history) == after
    kept = later.watermark.first()["last_processed_date"]
    assert kept is not None and kept >= mark["last_processed_date"]


def test_only_named_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "h")
    base = spark.range(2000).selectExpr(
        "id as business_key", "timestamp_ntz '2024-01-01 00:00:00' as effective_start_date",
        "md5(string(id)) as source_checksum", "md5(string(id)) as change_hash",
    )
    history.merge_stored(base, path, str(tmp_path / "s1"), buckets=16)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "h").rglob("*.parquet")}
    new = base.filter("business_key = 7").selectExpr(
        "business_key", "timestamp_ntz '2025-01-01 00:00:00' as effective_start_date", "source_checksum", "'new' as change_hash"
    )
    merged = history.merge_stored(new, path, str(tmp_path / "s2"), buckets=16)
    assert merged.count() == 2001 and merged.filter("is_current").count() == 2000
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "h").rglob("*.parquet")}
    touched = {p.parent.name for p in set(files.items()) ^ set(now.items()) for p in [p[0]]}
    assert len(touched) == 1


def test_amendment_outputs_as_files(spark, tmp_path):
    landing, template = domain.landing(spark, FOLDER), domain.template(spark)
    stamp = F.lit("2026-01-15 00:00:00").cast("timestamp")
    assessed = amendments.run_batch(landing, template, str(tmp_path), processing_ts=stamp)
    for _ in range(2):
        amendments.write_outputs(assessed, str(tmp_path / "files"), null_value="\\N")
    outputs = amendments.process(landing, template, processing_ts=stamp)
    for name, frame in (("rejects", outputs.rejects), ("documents", outputs.rendered)):
        back = scan_pipe_csv(spark, str(tmp_path / "files" / name), frame.schema, null_value="\\N")
        assert rows(back) == rows(frame)
    assert outputs.rejects.count() + outputs.rendered.count() == landing.count()
