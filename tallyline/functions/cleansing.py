"""Cleansing expressions for source-to-target mappings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status codes of the two mappings.
STATUS_TWO_WAY = {"ACTIVE": "A"}
STATUS_TWO_WAY_DEFAULT = "I"
STATUS_FOUR_WAY = {"ACTIVE": "A", "INACTIVE": "I", "PENDING": "P"}
STATUS_FOUR_WAY_DEFAULT = "U"

# Accepted amount range and retention in days (about seven years).
AMOUNT_RANGE = (0, "999999.99")
RETENTION_DAYS = 2555
RETENTION_MONTHS = 84

# Default text and patterns of region names and dates.
UNKNOWN = "UNKNOWN"
REGION_NAME = r"^[A-Z\s]+$"
NOT_IN_REGION_NAME = r"[^A-Z\s]"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def or_unknown(value: Column | str, default: str = UNKNOWN) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def upper_trim(value: Column | str, default: str | None = UNKNOWN) -> Column:
    """Trimmed upper-case text; NULL becomes ``default`` unless that is None."""
    text = F.upper(F.trim(_col(value)))
    return text if default is None else or_unknown(text, default)


def bounded_round(
    value: Column | str, bounds: tuple = AMOUNT_RANGE, digits: int = 2
) -> Column:
    """Rounded value when it lies within the closed bounds, otherwise NULL."""
    number = _col(value)
    low, high = (F.lit(b).cast("decimal(18,2)") for b in bounds)
    return F.when(number.between(low, high), F.round(number, digits))


def map_status(
    value: Column | str,
    mapping: Mapping[str, str] = STATUS_FOUR_WAY,
    default: str = STATUS_FOUR_WAY_DEFAULT,
) -> Column:
    """Short status code; values outside the mapping, NULL included, get ``default``."""
    status = _col(value)
    chain = F
    for long_form, code in mapping.items():
        chain = chain.when(status == long_form, F.lit(code))
    return chain.otherwise(F.lit(default))


def clean_region(value: Column | str) -> Column:
    """Keep upper-case names, strip every other character, empty text becomes UNKNOWN."""
    region = _col(value)
    return (
        F.when(F.length(region) == 0, F.lit(UNKNOWN))
        .when(region.rlike(REGION_NAME), region)
        .otherwise(F.regexp_replace(region, NOT_IN_REGION_NAME, ""))
    )


def iso_date_text(value: Column | str) -> Column:
    """Text of the form yyyy-MM-dd, anything else NULL."""
    text = _col(value)
    return F.when(text.rlike(ISO_DATE), text)


def retention_date(
    as_of: Column | None = None, days: int = RETENTION_DAYS, months: int | None = None
) -> Column:
    """Last day a record is kept: ``as_of`` plus days, or plus calendar months."""
    start = F.current_date() if as_of is None else as_of
    return F.date_add(start, days) if months is None else F.add_months(start, months)


def processing_timestamp(now: Column | None = None) -> Column:
    """Load time; pass ``now`` to make a run repeatable."""
    return F.current_timestamp() if now is None else now
