"""Data-quality checks. Each check is one aggregation whose result is a frame.

Checks return counts and flags as rows, so they can be stored, joined with
limits and tested; nothing is decided on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.functions.cleansing import AMOUNT_RANGE
from tallyline.functions.measures import count_where, percent
from tallyline.operators.sets import duplicated_keys

# Result words, share of NULLs that is too high, columns that must
# not be NULL, accepted score, allowed regions.
PASSED, FAILED = "PASSED", "FAILED"
NULL_LIMIT_PERCENT = 5.0
CRITICAL_COLUMNS = ("id", "column1", "created_date")
NON_NEGATIVE = ("TOTAL_TRANSACTIONS", "TOTAL_AMOUNT")
QUALITY_THRESHOLD = 0.95
REGIONS = ("NORTH", "SOUTH", "EAST", "WEST")


def _verdict(passed: Column) -> Column:
    return F.when(passed, F.lit(PASSED)).otherwise(F.lit(FAILED))


def _to_rows(summary: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """One-row aggregate to several rows, one per struct."""
    return summary.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs per column, in one pass."""
    return df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def basic_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: fails when the table is empty or a key is NULL."""
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    counted = df.agg(F.count("*").alias("row_count"), count_where(null_key).alias("null_keys"))
    passed = (F.col("row_count") > 0) & (F.col("null_keys") == 0)
    return counted.select(F.lit(table).alias("table_name"), "*", passed.alias("passed"))


def integrity_check(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    non_negative: Sequence[str] = NON_NEGATIVE,
) -> DataFrame:
    """One row: empty table, NULL keys and negative totals fail, duplicates only warn.

    Rows are first counted per key, so duplicates need no distinct count.
    """
    measured = [c for c in non_negative if c in df.columns]
    negative = F.lit(False)
    for name in measured:
        negative = negative | F.coalesce(F.col(name) < 0, F.lit(False))
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("__rows"), count_where(negative).alias("__negative")
    )
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    counted = per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(null_key, F.col("__rows"))), F.lit(0)).alias("null_keys"),
        count_where(F.col("__rows") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum("__negative"), F.lit(0)).alias("negative_rows"),
    )
    passed = (
        (F.col("row_count") > 0) & (F.col("null_keys") == 0) & (F.col("negative_rows") == 0)
    )
    return counted.select(F.lit(table).alias("table_name"), "*", passed.alias("passed"))


def require(check: DataFrame, column: str = "passed") -> None:
    """Fail unless the flag of a one-row check is true."""
    found = check.first()
    if not found[column]:
        raise ValueError(f"data quality check failed: {found.asDict()}")


class Rule(NamedTuple):
    """A condition in SQL that every row should meet."""

    name: str
    condition: str
    severity: str = "ERROR"


def rule_check(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its violations, all rules in one pass.

    A condition that is NULL is no violation. The overall status fails when a
    rule of severity ERROR does.
    """
    counted = df.agg(
        F.count("*").alias("total_records"),
        *[
            count_where(F.expr(f"NOT ({rule.condition})")).alias(f"__{i}")
            for i, rule in enumerate(rules)
        ],
    )
    broken = F.lit(False)
    for i, rule in enumerate(rules):
        if rule.severity == "ERROR":
            broken = broken | (F.col(f"__{i}") > 0)
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.col("total_records"),
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.condition).alias("condition"),
            F.lit(rule.severity).alias("severity"),
            F.col(f"__{i}").alias("violations"),
            _verdict(F.col(f"__{i}") == 0).alias("status"),
            _verdict(~broken).alias("overall_status"),
        )
        for i, rule in enumerate(rules)
    ]
    return _to_rows(counted, rows)


def taxonomy_rule(column: str, allowed: Sequence[str] = REGIONS) -> Rule:
    """Rule that a column holds one of the allowed values."""
    values = ", ".join(f"'{v}'" for v in allowed)
    return Rule(f"{column.lower()}_in_taxonomy", f"{column} IN ({values})")


def required_schema_check(
    df: DataFrame, required: StructType, critical: Sequence[str]
) -> DataFrame:
    """One row per required column: presence, type and NULLs in critical columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in critical if c in actual]
    nulls = null_counts(df, present) if present else df.agg(F.count("*").alias("__rows"))
    rows = []
    for field in required.fields:
        wanted, found = field.dataType.simpleString(), actual.get(field.name)
        missing = F.col(field.name) if field.name in present else F.lit(None).cast("bigint")
        ok = F.lit(found == wanted) & (F.coalesce(missing, F.lit(0)) == 0)
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(wanted).alias("expected_type"),
                F.lit(found).cast("string").alias("actual_type"),
                missing.alias("null_count"),
                ok.alias("passed"),
            )
        )
    return _to_rows(nulls, rows)


def null_profile(
    df: DataFrame,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    limit: float = NULL_LIMIT_PERCENT,
) -> DataFrame:
    """One row per column: NULLs, their share, and whether that is too much.

    The status of the whole profile fails when a critical column exceeds the limit.
    """
    counted = df.agg(
        F.count("*").alias("__total"),
        *[count_where(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    share = {c: percent(F.col(c), F.col("__total")) for c in df.columns}
    failed = F.lit(False)
    for name in df.columns:
        if name in critical:
            failed = failed | (share[name] > limit)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(name).alias("null_count"),
            share[name].alias("null_percentage"),
            F.lit(name in critical).alias("is_critical"),
            (share[name] > limit).alias("threshold_exceeded"),
            _verdict(~failed).alias("status"),
        )
        for name in df.columns
    ]
    return _to_rows(counted, rows)


def duplicate_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return duplicated_keys(df, keys)


def range_and_date_check(
    df: DataFrame,
    as_of: Column | None = None,
    amount: str = "column3",
    created: str = "created_date",
    text: str = "column2",
    bounds: tuple = AMOUNT_RANGE,
) -> DataFrame:
    """One row: amounts out of range, creation in the future, texts to be defaulted."""
    today = F.current_timestamp() if as_of is None else as_of
    low, high = (F.lit(b).cast("decimal(18,2)") for b in bounds)
    return df.agg(
        F.count("*").alias("total_records"),
        count_where(~F.col(amount).between(low, high)).alias("out_of_range"),
        count_where(F.col(created) > today).alias("future_dated"),
        count_where(F.col(text).isNull()).alias("defaulted_text"),
    )


def amendment_score(
    amendments: DataFrame, event_type: str = "MORTGAGE_AMENDMENT", rate_bounds: tuple = (0, 50)
) -> DataFrame:
    """One row: five issue counts and the score they leave.

    A row with several issues counts several times. The score of no rows is NULL.
    """
    low, high = rate_bounds
    rate = F.col("new_rate").try_cast("double")
    issues = {
        "null_event_ids": F.col("event_id").isNull() | (F.col("event_id") == ""),
        "null_loan_ids": F.col("loan_id").isNull() | (F.col("loan_id") == ""),
        "invalid_event_types": F.col("event_type") != event_type,
        "missing_effective_dates": F.col("effective_date").isNull()
        | (F.col("effective_date") == ""),
        "invalid_rates": (rate < low) | (rate > high),
    }
    counted = amendments.agg(
        F.count("*").alias("total_records"),
        *[count_where(condition).alias(name) for name, condition in issues.items()],
    )
    total = F.col("total_records")
    found = sum((F.col(name) for name in issues), F.lit(0))
    score = F.try_divide((total - found).cast("double"), total.cast("double")) * 100
    return counted.withColumn("quality_score_percentage", F.round(score, 2))


def quality_gate(
    df: DataFrame,
    keys: Sequence[str],
    parent: DataFrame,
    parent_key: str,
    child_key: str,
    as_of: Column | None = None,
    threshold: float = QUALITY_THRESHOLD,
) -> DataFrame:
    """One row: share of passed checks and whether it reaches the threshold.

    The checks are that there are rows, the NULL profile, duplicate keys, value ranges, dates
    and references to the parent. Each passes or fails as a whole, so one bad row fails its
    check; an empty table is never valid. The table is read once: per key and reference its
    rows, NULLs and values out of range are counted, then the reference is looked up.
    """
    low, high = (F.lit(b).cast("decimal(18,2)") for b in AMOUNT_RANGE)
    today = F.current_timestamp() if as_of is None else as_of
    nulls = {f"__null_{i}": count_where(F.col(c).isNull()) for i, c in enumerate(df.columns)}
    group = list(dict.fromkeys([*keys, child_key]))
    counted = df.groupBy(*group).agg(
        F.count("*").alias("__rows"),
        *[n.alias(name) for name, n in nulls.items()],
        count_where(~F.col("column3").between(low, high)).alias("__out"),
        count_where(F.col("created_date") > today).alias("__future"),
    )
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    found = counted.join(known, F.col(child_key) == F.col("__parent"), "left")
    orphan = F.col(child_key).isNotNull() & F.col("__parent").isNull()
    if set(group) != set(keys):
        found = found.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in ("__rows", *nulls, "__out", "__future")],
            count_where(orphan).alias("__orphans"),
        )
    else:
        found = found.withColumn("__orphans", orphan.cast("long"))
    whole = found.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("__rows", *nulls, "__out", "__future", "__orphans")],
        count_where(F.col("__rows") > 1).alias("__duplicates"),
    )
    critical = [f"__null_{i}" for i, c in enumerate(df.columns) if c in CRITICAL_COLUMNS]
    few_nulls = F.lit(True)
    for name in critical:
        share = percent(F.col(name), F.col("__rows"))
        few_nulls = few_nulls & ~F.coalesce(share > NULL_LIMIT_PERCENT, F.lit(False))
    some = F.col("__rows") > 0
    passed = [some, few_nulls, *[F.col(c) == 0 for c in ("__duplicates", "__out", "__future", "__orphans")]]
    n = sum((p.cast("int") for p in passed), F.lit(0)).cast("bigint")
    score = n.cast("double") / len(passed)
    return whole.select(
        F.lit(len(passed)).cast("bigint").alias("checks"),
        n.alias("passed_checks"),
        score.alias("data_quality_score"),
        (some & (score >= threshold)).alias("is_valid"),
    )


def dimension_availability(
    dimension: DataFrame, active: Column, required: Mapping[str, str]
) -> DataFrame:
    """One row: records, active records and NULLs of required columns.

    ``required`` maps a column to the name of its NULL count. Use
    ``table_or_empty`` for a dimension that may not exist yet.
    """
    return dimension.agg(
        F.count("*").alias("record_count"),
        count_where(active).alias("active_count"),
        *[count_where(F.col(c).isNull()).alias(name) for c, name in required.items()],
        (F.count("*") > 0).alias("available"),
    )
