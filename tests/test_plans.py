"""Shapes of plans that decide how the operations behave on large and skewed data."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tallyline.operators import joins, layout, quality, sets
from tallyline.operators.windows import latest_per_key
from tallyline.plans import amendments, domain, engagement, regulatory
from tests.plans import at_scale, planned, settings

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """60,000 transactions in 8 files; account 1 holds a third of them."""
    path = str(tmp_path_factory.mktemp("hot") / "transactions")
    spark.range(0, 60_000, 1, 8).selectExpr(
        "cast(id as int) as TRANSACTION_ID",
        "cast(if(id % 3 = 0, 1, 2 + id % 500) as int) as ACCOUNT_ID",
        "'D' as TRANSACTION_TYPE",
        "cast(id % 1000 as decimal(15,2)) as AMOUNT",
        "date'2024-01-01' as TRANSACTION_DATE",
    ).write.parquet(path)
    transactions = spark.read.parquet(path)
    accounts = spark.range(1, 600).selectExpr(
        "cast(id as int) as ACCOUNT_ID",
        "cast(if(id % 3 = 0, 1, id) as int) as CUSTOMER_ID",
        "cast(id % 7 as int) as BRANCH_ID",
    )
    customers = spark.range(1, 600).selectExpr("cast(id as int) as CUSTOMER_ID", "'n' as NAME")
    branches = spark.range(7).selectExpr("cast(id as int) as BRANCH_ID", "'b' as BRANCH_NAME")
    return transactions, accounts, customers, branches


def test_hot_account_is_split_in_the_row_join(spark, hot):
    transactions, accounts, customers, _ = hot
    with at_scale(spark):
        rows = regulatory.customer_transactions(customers, accounts, transactions)
        found = rows.collect()
        plan = planned(rows)
    assert "skew=true" in plan
    assert len(found) == 60_000
    assert len({r["TRANSACTION_ID"] for r in found}) == 60_000


def test_hot_account_is_added_up_before_the_summary_join(spark, hot):
    transactions, accounts, _, branches = hot
    with at_scale(spark):
        summary = regulatory.branch_summary(transactions, accounts, branches)
        plan = planned(summary)
        found = {r["BRANCH_ID"]: r["TOTAL_TRANSACTIONS"] for r in summary.collect()}
    # the scan of the transactions is aggregated before it is shuffled
    scan = plan.index("FileScan parquet")
    above = plan[:scan].rstrip()
    assert "partial_count" in above.split("Exchange")[-1]
    plain = transactions.join(accounts, "ACCOUNT_ID").groupBy("BRANCH_ID").count()
    assert found == {r["BRANCH_ID"]: r["count"] for r in plain.collect()}


def test_hot_key_of_a_left_join_is_split(spark, hot):
    transactions, _, _, _ = hot
    lookup = spark.range(1, 400).selectExpr("cast(id as int) as ACCOUNT_ID", "'found' as label")
    facts = transactions.select("TRANSACTION_ID", "ACCOUNT_ID", F.lit(None).cast("string").alias("label"))
    with at_scale(spark):
        filled = joins.scalar_backfill(facts, lookup, "ACCOUNT_ID", {"label": "none"})
        assert filled.count() == 60_000
        counted = filled.groupBy("label").count()
        found = dict(counted.collect())
    expected = transactions.filter("ACCOUNT_ID < 400").count()
    assert found == {"found": expected, "none": 60_000 - expected}


def test_rows_without_key_do_not_pile_up(spark, hot):
    """A third of the rows has no key: the left join spreads them as a skewed partition."""
    transactions, _, _, _ = hot
    facts = transactions.select(
        "TRANSACTION_ID",
        F.when(F.col("ACCOUNT_ID") != 1, F.col("ACCOUNT_ID")).alias("BRANCH_ID"),
        F.col("TRANSACTION_TYPE").alias("BRANCH_NAME"),
    )
    details = spark.range(1, 400).selectExpr(
        "cast(id as int) as BRANCH_ID", "'r' as REGION", "date'2024-01-01' as LAST_AUDIT_DATE", "'Y' as IS_ACTIVE"
    )
    with at_scale(spark):
        joined = regulatory.with_operational_details(facts, details)
        found = joined.collect()
        assert "skew=true" in planned(joined)
    assert len(found) == 60_000


@pytest.mark.parametrize("operation", ["latest", "duplicates"])
def test_ranking_is_cut_before_the_shuffle(spark, hot, operation):
    transactions = hot[0]
    if operation == "latest":
        rows = latest_per_key(transactions, ["ACCOUNT_ID"], ["TRANSACTION_DATE", "TRANSACTION_ID"])
    else:
        rows = sets.drop_duplicates(transactions, ["ACCOUNT_ID"], ["TRANSACTION_ID"])
    plan = planned(rows)
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]
    assert rows.count() == 501


def test_rebalance_splits_a_hot_key(spark, hot, tmp_path):
    path = str(tmp_path / "laid_out")
    with at_scale(spark):
        layout.partition_by_key(hot[0], ["ACCOUNT_ID"]).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("file", F.input_file_name())
    spread = placed.groupBy("ACCOUNT_ID").agg(F.count_distinct("file").alias("files"))
    files = {r["ACCOUNT_ID"]: r["files"] for r in spread.collect()}
    assert files[1] > 1
    assert placed.count() == 60_000


def test_users_are_counted_without_expand(spark):
    plan = planned(engagement.tile_counts(domain.tile_events(spark, FOLDER)))
    assert "Expand" not in plan
    assert re.search(r"hashpartitioning\(tile_id#\d+, user_id#\d+", plan)


def test_day_filter_reaches_the_scan(spark):
    plan = planned(registered.queries()["tile_daily_counts"](spark, FOLDER))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00" in pushed and "LessThan(ts,2024-01-06T00:00" in pushed
    read = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "value" not in read


def test_incremental_filter_reaches_the_scan(spark):
    plan = planned(registered.queries()["scan_incremental"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan
    assert "o_orderstatus" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_partition_filter_prunes_folders(spark, tmp_path):
    from tallyline.operators.projections import on_date

    frame = spark.range(48).selectExpr(
        "id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id as int)) as event_ts"
    ).withColumn("date", F.to_date("event_ts"))
    frame.write.partitionBy("date").parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    day = on_date(stored, "event_ts", "2024-01-02", partition_column="date")
    assert day.count() == 24
    assert "2024-01-02" in re.search(r"PartitionFilters: \[(.*?)\]", planned(day)).group(1)


def test_patterns_run_once_per_row(spark, tmp_path):
    path = str(tmp_path / "landing")
    domain.landing(spark, FOLDER).write.parquet(path)
    landing = spark.read.parquet(path)
    outputs = amendments.process(landing, domain.template(spark))
    plan = outputs.rendered._jdf.queryExecution().optimizedPlan().toString()
    # five header and six amendment fields; parse_rate looks at text of a few characters
    assert len(re.findall(r"regexp_extract\(payload_json", plan)) == 11


def test_template_needs_no_join(spark):
    outputs = amendments.process(domain.landing(spark, FOLDER), domain.template(spark))
    plan = planned(outputs.rendered)
    assert "Join" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_rules_take_one_pass(spark):
    rules = [quality.Rule(f"r{i}", f"id <> {i}") for i in range(20)]
    frame = domain.source_records(spark, FOLDER)
    plan = planned(quality.rule_check(frame, "t", rules))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_reconciliation_shuffles_counts_once(spark, hot):
    from tallyline.operators.reconciliation import reconcile

    found = reconcile(hot[0], hot[0], "ACCOUNT_ID", F.col("AMOUNT") > 0)
    plan = planned(found)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    with settings(spark, spark__sql__shuffle__partitions=4):
        assert {r["match"] for r in found.collect()} == {True, None}


def test_history_outside_the_batch_streams_through(spark, tmp_path):
    from tallyline.operators import history
    from tallyline.sources.writers import write_path

    def versions(keys, day):
        return spark.range(*keys).selectExpr(
            "id as business_key", f"timestamp'{day}' as effective_start_date", "'x' as source_checksum",
            f"md5('{day}') as change_hash",
        )

    stored = write_path(history.first_versions(versions((0, 5000), "2024-01-01")), str(tmp_path / "h"))
    merged = history.scd2_merge(stored, versions((0, 5), "2024-02-01"))
    plan = planned(merged)
    assert "FullOuter" not in plan and "LeftAnti" in plan
    rest = plan[plan.index("Union") :].split("LeftAnti")[0]
    assert "Exchange hashpartitioning" not in rest
    assert merged.count() == 5005
