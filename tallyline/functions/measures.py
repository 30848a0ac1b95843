"""Ratios and percentages that stay defined on empty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double; 0.0 when the denominator is not positive or NULL."""
    top, bottom = _col(numerator), _col(denominator)
    return F.when(bottom > 0, F.try_divide(top.cast("double"), bottom.cast("double"))).otherwise(
        F.lit(0.0)
    )


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` in percent; 0.0 for an empty whole."""
    return safe_ratio(part, whole) * 100


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
