"""Branch report and customer transactions on hand-counted rows."""

import datetime as dt
from decimal import Decimal

import pytest

from tallyline import schemas
from tallyline.operators.windows import latest_per_key
from tallyline.plans import regulatory

BRANCHES = [(1, "Harbour"), (2, "Market"), (3, "Station"), (4, "Airport")]
# account, customer, branch: branch 1 has two accounts
ACCOUNTS = [(11, 91, 1), (12, 92, 2), (13, 93, 3), (14, 91, 1), (15, 92, 4)]
# branch 1 three transactions, branch 2 two, branch 3 two
FIRST = [
    (1, 11, "100.10"), (2, 11, "200.20"), (3, 12, "10.00"), (4, 12, "5.50"),
    (5, 13, "1.01"), (6, 13, "2.02"), (7, 14, "50.00"),
]
# each of the accounts once more
SECOND = [(8, 11, "1.00"), (9, 12, "1.00"), (10, 13, "1.00"), (11, 14, "1.00")]
LATE = [(12, 15, "1200.00")]
DETAILS = [
    (1, "North", "2024-03-01", "Y"),
    (2, "South", "2024-02-01", "N"),
    (3, "East", None, "Y"),
]


def frame(spark, name, columns, rows):
    whole = schemas.schema(name)
    texts = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in r) for r in rows],
        ", ".join(f"{c} string" for c in columns),
    )
    return texts.select(*[texts[c].cast(whole[c].dataType) for c in columns])


@pytest.fixture
def tables(spark):
    def build(transactions, details=DETAILS):
        rows = [(i, a, "DEPOSIT", amount, "2024-05-01") for i, a, amount in transactions]
        return (
            frame(
                spark,
                "transaction",
                ["TRANSACTION_ID", "ACCOUNT_ID", "TRANSACTION_TYPE", "AMOUNT", "TRANSACTION_DATE"],
                rows,
            ),
            frame(spark, "account", ["ACCOUNT_ID", "CUSTOMER_ID", "BRANCH_ID"], ACCOUNTS),
            frame(spark, "branch", ["BRANCH_ID", "BRANCH_NAME"], BRANCHES),
            frame(
                spark,
                "branch_operational_details",
                ["BRANCH_ID", "REGION", "LAST_AUDIT_DATE", "IS_ACTIVE"],
                details,
            ),
        )

    return build


def as_dict(report):
    return {row[0]: tuple(row)[2:] for row in report.collect()}


def test_insert_all_counts(tables):
    report = regulatory.branch_summary_report(*tables(FIRST))
    assert as_dict(report) == {
        1: (3, 350.3, "North", "2024-03-01"),
        2: (2, 15.5, None, None),
        3: (2, 3.03, "East", None),
    }


def test_update_adds_to_each_branch(tables):
    report = regulatory.branch_summary_report(*tables(FIRST + SECOND))
    assert {b: r[:2] for b, r in as_dict(report).items()} == {
        1: (5, 352.3),
        2: (3, 16.5),
        3: (3, 4.03),
    }


def test_branch_without_details_stays(tables):
    report = as_dict(regulatory.branch_summary_report(*tables(FIRST + LATE)))
    assert report[4] == (1, 1200.0, None, None)


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        ("active_null", {1: ("North", "2024-03-01"), 2: (None, None), 3: ("East", None), 4: (None, None)}),
        ("active_unknown", {1: ("North", "2024-03-01"), 2: ("UNKNOWN", None), 3: ("East", None), 4: ("UNKNOWN", None)}),
        ("all_sentinel", {1: ("North", "2024-03-01"), 2: ("South", "2024-02-01"), 3: ("East", "NOT_AVAILABLE"), 4: ("UNKNOWN", "NOT_AVAILABLE")}),
        ("active_inner", {1: ("North", "2024-03-01"), 2: (None, None), 3: ("East", None)}),
    ],
)
def test_policies(tables, policy, expected):
    report = regulatory.branch_summary_report(*tables(FIRST + LATE), policy=policy)
    assert {b: r[2:] for b, r in as_dict(report).items()} == expected


def test_report_has_the_declared_types(tables):
    report = regulatory.branch_summary_report(*tables(FIRST))
    declared = schemas.schema("branch_summary_report")
    assert [(f.name, f.dataType) for f in report.schema] == [
        (f.name, f.dataType) for f in declared
    ]


def test_sums_are_exact_decimals(tables, spark):
    transactions, accounts, branches, _ = tables([(i, 11, "0.10") for i in range(3)])
    row = regulatory.branch_summary(transactions, accounts, branches).first()
    assert row["TOTAL_AMOUNT"] == Decimal("0.30")


def test_duplicated_account_and_branch_rows_count_as_in_a_plain_join(tables):
    transactions, accounts, branches, _ = tables(FIRST)
    doubled = accounts.union(accounts.filter("ACCOUNT_ID = 11"))
    twice = branches.union(branches.filter("BRANCH_ID = 1"))
    plain = (
        transactions.join(doubled, "ACCOUNT_ID")
        .join(twice, "BRANCH_ID")
        .groupBy("BRANCH_ID", "BRANCH_NAME")
        .count()
    )
    ours = regulatory.branch_summary(transactions, doubled, twice)
    assert {(r[0], r[2]) for r in ours.collect()} == {(r[0], r[2]) for r in plain.collect()}


def test_duplicated_details_multiply_unless_reduced(tables):
    details = DETAILS + [(1, "Nord", "2024-04-01", "Y")]
    transactions, accounts, branches, raw = tables(FIRST, details)
    latest = latest_per_key(raw, ["BRANCH_ID"], ["LAST_AUDIT_DATE"])
    report = regulatory.branch_summary_report(transactions, accounts, branches, latest)
    assert as_dict(report)[1] == (3, 350.3, "Nord", "2024-04-01")
    plain = regulatory.branch_summary_report(transactions, accounts, branches, raw)
    assert plain.count() == 4


def test_customer_transactions(tables, spark):
    transactions, accounts, _, _ = tables(FIRST)
    customers = frame(spark, "customer", ["CUSTOMER_ID", "NAME"], [(91, "Ada"), (92, "Ben")])
    rows = regulatory.customer_transactions_ordered(customers, accounts, transactions)
    assert rows.columns == schemas.schema("aml_customer_transactions").fieldNames()
    found = rows.collect()
    # account 13 belongs to a customer that does not exist
    assert [r["TRANSACTION_ID"] for r in found] == [1, 2, 7, 3, 4]
    assert found[0]["TRANSACTION_DATE"] == dt.date(2024, 5, 1)


def test_business_rules(spark):
    joined = spark.createDataFrame(
        [
            (1, "a", 1, 1.0, " north ", "2024-01-15", "Y"),
            (2, "b", 1, 1.0, None, "2024-01-15", "Y"),
            (3, "c", 1, 1.0, "east", "2024-01-15", "N"),
            (4, "d", 1, 1.0, "east", "2024-01-15", None),
        ],
        "BRANCH_ID int, BRANCH_NAME string, TOTAL_TRANSACTIONS int, TOTAL_AMOUNT double, "
        "REGION string, LAST_AUDIT_DATE string, IS_ACTIVE string",
    )
    assert [tuple(r)[4:] for r in regulatory.branch_business_rules(joined).collect()] == [
        ("NORTH", "2024-01-15"),
        ("UNKNOWN", "2024-01-15"),
        ("INACTIVE", None),
        ("INACTIVE", None),
    ]


def test_region_totals_and_coverage(tables):
    report = regulatory.branch_summary_report(*tables(FIRST + LATE), policy="all_sentinel")
    totals = regulatory.region_totals(report).collect()
    assert [tuple(r) for r in totals] == [
        ("UNKNOWN", 1, 1200.0),
        ("North", 1, 350.3),
        ("South", 1, 15.5),
        ("East", 1, 3.03),
    ]
    shares = {r[0]: r[3] for r in regulatory.audit_coverage(report).collect()}
    assert shares == {"UNKNOWN": 0.0, "North": 100.0, "South": 100.0, "East": 0.0}
