"""Time of the operations beside straightforward versions of the same work.

The straightforward versions use Python functions per row, one job per check and
joins of raw rows. Both sides read the same stored tables and drop their result.
Prints one JSON line. BENCH_SF_DIR names the data folder.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bench import session
from tallyline.operators import joins, quality
from tallyline.plans import amendments, domain, engagement, regulatory
from tallyline.sources.workspace import new_path
from tallyline.sources.writers import write_path


def drop(df):
    df.write.format("noop").mode("overwrite").save()


def find_text(payload, key):
    match = re.search(rf'"{key}"\s*:\s*"([^"]*)"', payload or "")
    return match.group(1) if match else ""


def pairs(spark, folder):
    landing = write_path(domain.landing(spark, folder), new_path(spark, "landing"))
    tiles = write_path(domain.tile_events(spark, folder), new_path(spark, "tiles"))
    records = write_path(domain.source_records(spark, folder), new_path(spark, "records"))
    accounts, branches = domain.accounts(spark, folder), domain.branches(spark, folder)
    transactions = domain.transactions(spark, folder)
    orders, lines = domain.table(spark, folder, "orders"), domain.table(spark, folder, "lineitem")

    by_row = F.udf(find_text, T.StringType())

    def header_by_udf():
        fields = [by_row("payload_json", F.lit(k)).alias(k) for k in amendments.HEADER_FIELDS]
        drop(landing.select(*fields, *amendments.ENVELOPE))

    def nulls_by_job():
        for column in records.columns:
            records.filter(F.col(column).isNull()).count()
        records.count()

    def distinct_by_expand():
        seen = [
            F.countDistinct(F.when(F.col("event_type") == kind, F.col("user_id")))
            for kind in ("TILE_VIEW", "TILE_CLICK")
        ]
        drop(tiles.groupBy("tile_id").agg(*seen))

    def summary_of_raw_rows():
        joined = transactions.join(accounts, "ACCOUNT_ID").join(branches, "BRANCH_ID")
        total = joined.groupBy("BRANCH_ID", "BRANCH_NAME").agg(F.count("*"), F.sum("AMOUNT"))
        drop(total)

    def keys_on_the_driver():
        left = {r[0] for r in orders.select("o_orderkey").collect()}
        right = {r[0] for r in lines.select("l_orderkey").collect()}
        return left - right, right - left

    def keys_as_rows():
        source = orders.select(F.col("o_orderkey").alias("k"))
        drop(joins.key_reconcile(source, lines.select(F.col("l_orderkey").alias("k")), "k"))

    return {
        "header_fields": (lambda: drop(amendments.extract_event_meta(landing)), header_by_udf),
        "null_profile": (lambda: drop(quality.null_profile(records)), nulls_by_job),
        "tile_users": (lambda: drop(engagement.tile_counts(tiles)), distinct_by_expand),
        "branch_summary": (
            lambda: drop(regulatory.branch_summary(transactions, accounts, branches)),
            summary_of_raw_rows,
        ),
        "key_reconcile": (keys_as_rows, keys_on_the_driver),
    }


def best(run, times=3):
    run()
    spent = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        spent.append(time.perf_counter() - start)
    return round(min(spent), 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count())))
    found = {
        name: {"ours": best(ours), "plain": best(plain)}
        for name, (ours, plain) in pairs(spark, folder).items()
    }
    spark.stop()
    print(json.dumps(found))


if __name__ == "__main__":
    main()
