"""Observations at instants to daily values, by the days of each station's own zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayledger.functions.zones import day_hours, local_day
from dayledger.operators.joining import null_safe_join

# How a day's value is made of its observations, by measure.
DAILY_KINDS = {
    "temperature_mean_c": "mean",
    "wind_gust_max_kmh": "max",
    "precipitation_sum_mm": "sum",
}
_KINDS = {"mean": F.mean, "max": F.max, "min": F.min, "sum": F.sum}


def with_zone(
    rows: DataFrame, stations: DataFrame, on: list[str], zone: str = "zone", missing: str | None = None
) -> DataFrame:
    """Rows with their station's zone; ``missing`` stands in where there is none."""
    known = stations.select(*on, zone)
    joined = null_safe_join(rows, known, on, "left")
    if missing is None:
        return joined
    return joined.withColumn(zone, F.coalesce(zone, F.lit(missing)))


def with_local_day(
    rows: DataFrame, instant: str, zone: str | Column = "zone", into: str = "date"
) -> DataFrame:
    """Add the local day of each row's instant."""
    return rows.withColumn(into, local_day(F.col(instant), F.col(zone) if isinstance(zone, str) else zone))


def daily_values(
    rows: DataFrame,
    keys: list[str],
    instant: str,
    zone: str = "zone",
    kinds: dict[str, str] = DAILY_KINDS,
    into: str = "date",
) -> DataFrame:
    """One row per key, zone and local day: the measures, ``observations`` and ``hours``, the length
    of the day there.

    ``kinds`` names a column and how a day's value is made of it: mean, max, min or sum. NULL values
    do not count; a day without any value of a measure has NULL. Sums are added up where the rows
    lie, so a station with a third of all rows sends on one row per task and day.
    """
    unknown = set(kinds.values()) - set(_KINDS)
    if unknown:
        raise ValueError(f"no such kind of daily value: {sorted(unknown)}")
    days = with_local_day(rows, instant, zone, into)
    daily = days.groupBy(*keys, zone, into).agg(
        *[_KINDS[kind](name).alias(name) for name, kind in kinds.items()],
        F.count(instant).alias("observations"),
    )
    return daily.withColumn("hours", day_hours(F.col(into), F.col(zone)))


def complete_days(daily: DataFrame, per_hour: int = 1) -> DataFrame:
    """Days with all their observations: 23 or 25 hours where the clock changes."""
    return daily.where(F.col("observations") >= F.col("hours") * per_hour)
