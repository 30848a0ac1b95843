"""Daily tile engagement: distinct users per tile, totals and click rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.cleansing import UNKNOWN, or_unknown
from tallyline.functions.measures import safe_ratio
from tallyline.operators.governance import evolve_schema
from tallyline.operators.projections import default_zero, on_date, only_active, with_constants
from tallyline.operators.windows import latest_per_key
from tallyline.sources.writers import replace_partition, replace_partitions

# Measures of the daily summary and the rows they count users of.
TILE_MEASURES = {
    "unique_tile_views": "event_type = 'TILE_VIEW'",
    "unique_tile_clicks": "event_type = 'TILE_CLICK'",
}
INTERSTITIAL_MEASURES = {
    "unique_interstitial_views": "interstitial_view_flag",
    "unique_interstitial_primary_clicks": "primary_button_click_flag",
    "unique_interstitial_secondary_clicks": "secondary_button_click_flag",
}

# Totals of the global report and the measures they add up.
TOTALS = {
    "total_tile_views": "unique_tile_views",
    "total_tile_clicks": "unique_tile_clicks",
    "total_interstitial_views": "unique_interstitial_views",
    "total_primary_clicks": "unique_interstitial_primary_clicks",
    "total_secondary_clicks": "unique_interstitial_secondary_clicks",
}
RATES = {
    "overall_ctr": ("total_tile_clicks", "total_tile_views"),
    "overall_primary_ctr": ("total_primary_clicks", "total_interstitial_views"),
    "overall_secondary_ctr": ("total_secondary_clicks", "total_interstitial_views"),
}


def distinct_users(
    events: DataFrame, measures: Mapping[str, str], by: str | Sequence[str] = "tile_id", user: str = "user_id"
) -> DataFrame:
    """Distinct users per group for several conditions at once.

    First one row per group and user says which conditions the user met, then the
    groups add these up. Both steps combine before their shuffle and the first is
    spread by user, so a group with a third of all events is no hot spot. Rows
    that meet no condition lose their user, which leaves one row per group and
    task of them. A row without user, or with an unknown condition, counts for
    nothing.
    """
    met = {name: F.coalesce(F.expr(sql), F.lit(False)) for name, sql in measures.items()}
    counted = reduce(or_, met.values())
    groups = [by] if isinstance(by, str) else list(by)
    flagged = events.select(
        *groups,
        F.when(counted, F.col(user)).alias(user),
        *[condition.cast("int").alias(name) for name, condition in met.items()],
    )
    per_user = flagged.groupBy(*groups, user).agg(*[F.max(name).alias(name) for name in met])
    known = F.col(user).isNotNull()
    return per_user.groupBy(*groups).agg(
        *[F.sum(F.when(known, F.col(name)).otherwise(0)).alias(name) for name in met]
    )


def tile_counts(tile_events: DataFrame) -> DataFrame:
    """Users who saw and who clicked each tile."""
    return distinct_users(tile_events, TILE_MEASURES)


def interstitial_counts(interstitial_events: DataFrame) -> DataFrame:
    """Users who saw each interstitial and who pressed its buttons."""
    return distinct_users(interstitial_events, INTERSTITIAL_MEASURES)


def combined_counts(tiles: DataFrame, interstitials: DataFrame) -> DataFrame:
    """Tiles of either side; tiles without id stay separate rows."""
    return tiles.join(interstitials, "tile_id", "full_outer")


def daily_summary(
    tile_events: DataFrame, interstitial_events: DataFrame, date: str | dt.date
) -> DataFrame:
    """One row per tile for one day, 0 where a side has no events."""
    tiles = tile_counts(on_date(tile_events, "event_ts", date))
    interstitials = interstitial_counts(on_date(interstitial_events, "event_ts", date))
    measures = [*TILE_MEASURES, *INTERSTITIAL_MEASURES]
    both = default_zero(combined_counts(tiles, interstitials), measures)
    day = F.lit(date).cast("date")
    return with_constants(both, date=day).select("date", "tile_id", *measures)


def current_categories(metadata: DataFrame) -> DataFrame:
    """One category per active tile, the last updated one."""
    active = only_active(metadata, "is_active")
    return latest_per_key(active, ["tile_id"], ["updated_ts", "tile_category"]).select(
        "tile_id", "tile_category"
    )


def with_category(summary: DataFrame, metadata: DataFrame) -> DataFrame:
    """Category of active tiles after ``tile_id``; UNKNOWN for all others."""
    joined = summary.join(current_categories(metadata), "tile_id", "left")
    rest = [c for c in summary.columns if c not in ("date", "tile_id")]
    return joined.select(
        "date", "tile_id", or_unknown("tile_category", UNKNOWN).alias("tile_category"), *rest
    )


def _totals() -> list[Column]:
    return [F.sum(measure).alias(total) for total, measure in TOTALS.items()]


def _with_rates(totals: DataFrame) -> DataFrame:
    return totals.withColumns({name: safe_ratio(*pair) for name, pair in RATES.items()})


def global_kpis(summary: DataFrame) -> DataFrame:
    """Totals and click rates per day.

    Totals add up the per-tile counts: a user of two tiles counts twice.
    """
    return _with_rates(summary.groupBy("date").agg(*_totals()))


def category_rollup(summary: DataFrame) -> DataFrame:
    """Totals and click rates per tile category."""
    counted = summary.groupBy("tile_category").agg(F.count("*").alias("tile_count"), *_totals())
    return _with_rates(counted)


def category_distribution(summary: DataFrame, date: str | dt.date) -> DataFrame:
    """Number of tiles per category on one day."""
    day = summary.filter(F.col("date") == F.lit(date).cast("date"))
    return day.groupBy("tile_category").agg(F.count("*").alias("tile_count"))


class Reports(NamedTuple):
    daily: DataFrame
    kpis: DataFrame


def run_day(
    tile_events: DataFrame,
    interstitial_events: DataFrame,
    folder: str,
    date: str | dt.date,
    metadata: DataFrame | None = None,
    fmt: str = "parquet",
) -> Reports:
    """Replace one day of the daily summary and of the global report.

    The global report is made from the stored summary of the day, so the events
    are read and counted once. The table always has the category, which is NULL
    for days written without metadata.
    """
    summary = daily_summary(tile_events, interstitial_events, date)
    if metadata is not None:
        summary = with_category(summary, metadata)
    summary = evolve_schema(summary, schemas.schema("tile_daily_summary"))
    daily = replace_partition(summary, f"{folder}/daily_summary", "date", date, fmt)
    stored = daily.filter(F.col("date") == F.lit(date).cast("date"))
    kpis = replace_partition(global_kpis(stored), f"{folder}/global_kpis", "date", date, fmt)
    return Reports(daily, kpis)


def touched_days(
    events: Sequence[DataFrame], arrival: str, since: Column | None = None, timestamp: str = "event_ts"
) -> list[dt.date]:
    """Days of the events that arrived from ``since`` on, of all without it; NULL is no day."""
    days = None
    for rows in events:
        recent = rows if since is None else rows.filter(F.col(arrival) >= since)
        found = recent.select(F.to_date(timestamp).alias("day"))
        days = found if days is None else days.union(found)
    return sorted(r[0] for r in days.filter("day is not null").distinct().collect())


def daily_summaries(tile_events: DataFrame, interstitial_events: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """``daily_summary`` of several days from one pass over the events."""
    sides = []
    for events, measures in ((tile_events, TILE_MEASURES), (interstitial_events, INTERSTITIAL_MEASURES)):
        day = F.to_date("event_ts")
        # the range reaches the scan, the list leaves out the days between
        rows = events.filter(day.between(F.lit(min(days)), F.lit(max(days))) & day.isin(*days))
        sides.append(distinct_users(rows.withColumn("date", day), measures, ["date", "tile_id"]))
    tiles, interstitials = sides
    same = (tiles["date"] == interstitials["date"]) & (tiles["tile_id"] == interstitials["tile_id"])
    both = tiles.join(interstitials, same, "full_outer").select(
        F.coalesce(tiles["date"], interstitials["date"]).alias("date"),
        F.coalesce(tiles["tile_id"], interstitials["tile_id"]).alias("tile_id"),
        *[tiles[m] for m in TILE_MEASURES],
        *[interstitials[m] for m in INTERSTITIAL_MEASURES],
    )
    return default_zero(both, [*TILE_MEASURES, *INTERSTITIAL_MEASURES])


def run_arrivals(
    tile_events: DataFrame,
    interstitial_events: DataFrame,
    folder: str,
    arrival: str,
    since: Column | None = None,
    metadata: DataFrame | None = None,
    fmt: str = "parquet",
) -> Reports | None:
    """Replace the days that events arrived for since a bound, late ones included.

    Such a day is made anew from all its events; all of them are replaced in one write per
    report, a day that is left without rows is emptied, and no other day is touched. Without
    arrivals nothing is written and there is no result. The days are as many as a history has,
    and their list is the only thing that reaches the driver.
    """
    days = touched_days([tile_events, interstitial_events], arrival, since)
    if not days:
        return None
    summary = daily_summaries(tile_events, interstitial_events, days)
    if metadata is not None:
        summary = with_category(summary, metadata)
    summary = evolve_schema(summary, schemas.schema("tile_daily_summary"))
    daily = replace_partitions(summary, f"{folder}/daily_summary", "date", days, fmt)
    stored = daily.filter(F.col("date").isin(*days))
    kpis = replace_partitions(global_kpis(stored), f"{folder}/global_kpis", "date", days, fmt)
    return Reports(daily, kpis)
