"""Customer transactions and the branch summary report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.cleansing import UNKNOWN, upper_trim
from tallyline.functions.measures import count_where
from tallyline.operators.layout import order_by_keys
from tallyline.operators.projections import cast_columns, having
from tallyline.operators.quality import integrity_check, require
from tallyline.sources import keyed, releases
from tallyline.sources.writers import publish, write_path

# Flag and default texts of the operational details.
ACTIVE = "Y"
INACTIVE_REGION = "INACTIVE"
NO_AUDIT = "NOT_AVAILABLE"

# Report column types.
REPORT_TYPES = {
    "BRANCH_ID": "bigint",
    "TOTAL_TRANSACTIONS": "bigint",
    "TOTAL_AMOUNT": "double",
}


def customer_transactions(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Every transaction with its account and customer.

    Customers meet accounts first, so the large transaction side is shuffled
    once, by account. A hot account is split by the adaptive skew join.
    """
    owners = customers.select("CUSTOMER_ID", "NAME").join(
        accounts.select("CUSTOMER_ID", "ACCOUNT_ID"), "CUSTOMER_ID"
    )
    columns = schemas.schema("aml_customer_transactions").fieldNames()
    return transactions.join(owners, "ACCOUNT_ID").select(*columns)


def customer_transactions_ordered(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame
) -> DataFrame:
    """The same rows by customer and date.

    The transaction id ends the order, so that rows of one customer and day can
    be spread over several range partitions.
    """
    rows = customer_transactions(customers, accounts, transactions)
    return order_by_keys(rows, ["CUSTOMER_ID", "TRANSACTION_DATE", "TRANSACTION_ID"])


def branch_summary(
    transactions: DataFrame, accounts: DataFrame, branches: DataFrame
) -> DataFrame:
    """Number and sum of transactions per branch.

    Transactions are added up per account before the join, and accounts per
    branch before the branch names come in. What is shuffled and joined is one
    row per key and task, whatever share of the rows a single account has.
    """

    def added_up(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("TOTAL_TRANSACTIONS").alias("TOTAL_TRANSACTIONS"),
            F.sum("TOTAL_AMOUNT").cast("decimal(25,2)").alias("TOTAL_AMOUNT"),
        )

    per_account = transactions.groupBy("ACCOUNT_ID").agg(
        F.count("*").alias("TOTAL_TRANSACTIONS"),
        F.sum("AMOUNT").cast("decimal(25,2)").alias("TOTAL_AMOUNT"),
    )
    per_branch = added_up(
        per_account.join(accounts.select("ACCOUNT_ID", "BRANCH_ID"), "ACCOUNT_ID"), "BRANCH_ID"
    )
    named = per_branch.join(branches.select("BRANCH_ID", "BRANCH_NAME"), "BRANCH_ID")
    return added_up(named, "BRANCH_ID", "BRANCH_NAME")


def report_types(summary: DataFrame) -> DataFrame:
    """Column types of the stored report."""
    return cast_columns(summary, REPORT_TYPES)


def _is_active() -> Column:
    return F.col("IS_ACTIVE") == ACTIVE


def with_operational_details(
    summary: DataFrame, details: DataFrame, policy: str = "active_null"
) -> DataFrame:
    """Add REGION and LAST_AUDIT_DATE (text) to a branch summary.

    Policies:

    * ``active_null``: both only for active branches, otherwise NULL;
    * ``active_unknown``: active details only, a missing region is UNKNOWN;
    * ``all_sentinel``: details of any state, UNKNOWN and NOT_AVAILABLE for gaps;
    * ``active_inner``: as ``active_null``, branches without details are left out.

    Details must hold one row per branch; reduce them with ``latest_per_key``
    first where they may hold more.
    """
    facts = details.select(
        "BRANCH_ID", "REGION", F.col("LAST_AUDIT_DATE").cast("string"), "IS_ACTIVE"
    )
    region, audited = F.col("REGION"), F.col("LAST_AUDIT_DATE")
    if policy == "active_unknown":
        facts = facts.filter(_is_active())
    shown = {
        "active_null": (F.when(_is_active(), region), F.when(_is_active(), audited)),
        "active_inner": (F.when(_is_active(), region), F.when(_is_active(), audited)),
        "active_unknown": (F.coalesce(region, F.lit(UNKNOWN)), audited),
        "all_sentinel": (
            F.coalesce(region, F.lit(UNKNOWN)),
            F.coalesce(audited, F.lit(NO_AUDIT)),
        ),
    }[policy]
    how = "inner" if policy == "active_inner" else "left"
    return summary.join(facts, "BRANCH_ID", how).select(
        *summary.columns, shown[0].alias("REGION"), shown[1].alias("LAST_AUDIT_DATE")
    )


def branch_summary_report(
    transactions: DataFrame,
    accounts: DataFrame,
    branches: DataFrame,
    details: DataFrame,
    policy: str = "active_null",
) -> DataFrame:
    """The complete report: branches with transactions, details, stored types, by branch."""
    summary = having(branch_summary(transactions, accounts, branches), "TOTAL_TRANSACTIONS")
    report = report_types(with_operational_details(summary, details, policy))
    return order_by_keys(report, ["BRANCH_ID"])


def branch_business_rules(joined: DataFrame) -> DataFrame:
    """Region in capitals for active branches, INACTIVE for all others."""
    return joined.select(
        "BRANCH_ID",
        "BRANCH_NAME",
        "TOTAL_TRANSACTIONS",
        "TOTAL_AMOUNT",
        F.when(_is_active(), upper_trim("REGION")).otherwise(F.lit(INACTIVE_REGION)).alias("REGION"),
        F.when(_is_active(), F.col("LAST_AUDIT_DATE").cast("string")).alias("LAST_AUDIT_DATE"),
    )


def region_totals(report: DataFrame) -> DataFrame:
    """Branches and amount per known region, largest amount first."""
    totals = (
        report.filter(F.col("REGION").isNotNull())
        .groupBy("REGION")
        .agg(
            F.count("*").alias("branch_count"),
            F.sum(F.col("TOTAL_AMOUNT").cast("decimal(25,2)"))
            .cast("double")
            .alias("total_regional_amount"),
        )
    )
    return order_by_keys(totals, [F.desc("total_regional_amount"), F.col("REGION")])


def audit_coverage(report: DataFrame) -> DataFrame:
    """Per region: branches, audited branches and their share in percent."""
    counted = report.groupBy("REGION").agg(
        F.count("*").alias("total_branches"),
        count_where(F.col("LAST_AUDIT_DATE") != NO_AUDIT).alias("audited_branches"),
    )
    share = F.col("audited_branches") * 100.0 / F.col("total_branches")
    return counted.withColumn("audit_coverage_pct", F.round(share.cast("double"), 2))


class Reports(NamedTuple):
    customer_transactions: DataFrame
    branch_summary: DataFrame


def run_reports(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    branches: DataFrame,
    details: DataFrame,
    folder: str,
    policy: str = "active_null",
    fmt: str = "parquet",
) -> Reports:
    """Stage both reports, check what is staged, and publish; a failed check fails the run.

    The checks read the staged reports, so nothing is computed twice, and a run that fails
    leaves the reports of the last good one.
    """
    aml = write_path(
        customer_transactions(customers, accounts, transactions),
        f"{folder}/staged/aml_customer_transactions",
        fmt=fmt,
    )
    report = write_path(
        branch_summary_report(transactions, accounts, branches, details, policy),
        f"{folder}/staged/branch_summary_report",
        fmt=fmt,
    )
    require(integrity_check(aml, "AML_CUSTOMER_TRANSACTIONS", ["TRANSACTION_ID"]))
    require(integrity_check(report, "BRANCH_SUMMARY_REPORT", ["BRANCH_ID"]))
    reports = Reports(
        publish(aml, f"{folder}/aml_customer_transactions", fmt),
        publish(report, f"{folder}/branch_summary_report", fmt),
    )
    keyed.remove(aml.sparkSession, f"{folder}/staged")
    return reports


def release_reports(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    branches: DataFrame,
    details: DataFrame,
    folder: str,
    policy: str = "active_null",
    fmt: str = "parquet",
    database: str | None = None,
) -> Reports:
    """Both reports as one release: written once, checked, and published together or not at all.

    The same reports and checks as ``run_reports``, for readers that go through
    ``releases.read`` or the catalog tables of ``database``.
    """
    keys = {"aml_customer_transactions": "TRANSACTION_ID", "branch_summary_report": "BRANCH_ID"}
    written = releases.release(
        transactions.sparkSession,
        folder,
        {
            "aml_customer_transactions": lambda _: customer_transactions(customers, accounts, transactions),
            "branch_summary_report": lambda _: branch_summary_report(
                transactions, accounts, branches, details, policy
            ),
        },
        check=lambda name, rows: require(integrity_check(rows, name.upper(), [keys[name]])),
        database=database,
        fmt=fmt,
    )
    return Reports(*written.values())
