"""Load report: what was loaded and how many stations succeeded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayledger.operators.joining import null_safe_join
from dayledger.operators.pairing import STATION_KEY
from dayledger.session import written

# Names of the report and the flags that they total.
FLAG_TOTALS = {
    "extreme_temp_count": "extreme_temperature",
    "extreme_wind_count": "extreme_wind",
    "extreme_precip_count": "extreme_precipitation",
}


def load_report(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: records, distinct dates and stations, totals of the three flags.

    One pass: rows become one per station, map side first, with the station's totals and its
    set of dates. Only these sets are exploded; each task sends on its own distinct dates.
    """
    if approximate:
        return rows.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.approx_count_distinct("date").alias("unique_dates"),
            F.approx_count_distinct("station_name").alias("unique_stations"),
            *[F.sum(flag).alias(name) for name, flag in FLAG_TOTALS.items()],
        )
    stations = rows.groupBy("station_name").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.collect_set("date").alias("_dates"),
        *[F.sum(flag).alias(name) for name, flag in FLAG_TOTALS.items()],
    )
    dates = stations.select("*", F.posexplode_outer("_dates").alias("_k", "_date"))
    first = F.coalesce(F.col("_k"), F.lit(0)) == 0
    return dates.agg(
        F.coalesce(F.sum(F.when(first, F.col("_rows"))), F.lit(0)).alias("total_records"),
        F.size(F.collect_set("_date")).cast("long").alias("unique_dates"),
        F.count_if(first & F.col("station_name").isNotNull()).alias("unique_stations"),
        *[F.sum(F.when(first, F.col(name))).alias(name) for name in FLAG_TOTALS],
    )


#: Names that stand more than once in a registry, and may be held beside the totals of a load.
MOST_REPEATED = 100_000


def row_totals() -> list[Column]:
    """Totals that tasks take while they write rows: the flags, and the set of days.

    Days are few, however many rows there are; so the set, unlike one of stations, is small.
    """
    return [
        *[F.sum(flag).alias(name) for name, flag in FLAG_TOTALS.items()],
        F.collect_set(as_landed(F.col("date"))).alias("dates"),
    ]


#: Registers of a sketch, as a power of two: 2 to the 14th errs by less than one hundredth, mostly.
SKETCH_SIZE = 14


def sketch_totals(size: int = SKETCH_SIZE) -> list[Column]:
    """Sketches of the days and stations, which tasks take while they write rows; 16 kB each."""
    return [
        F.hll_sketch_agg(as_landed(F.col(c)), size).alias(into)
        for c, into in (("date", "date_sketch"), ("station_name", "station_sketch"))
    ]


def load_sketch(rows: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row that can be merged with those of other loads: records, flags, and two sketches."""
    text = rows.withColumns({c: F.col(c).cast("string") for c in ("date", "station_name")})
    return text.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.coalesce(F.sum(flag), F.lit(0)).alias(name) for name, flag in FLAG_TOTALS.items()],
        *sketch_totals(size),
    )


def merged_report(sketches: DataFrame, exact: DataFrame | None = None) -> DataFrame:
    """The report of all loads whose sketches are given, without a look at their rows.

    Records and flags add up exactly. Days and stations that several loads share count once, within
    the sketch's error; with ``exact``, the rows of the loads, they are counted instead.
    """
    totals = sketches.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_records", *FLAG_TOTALS)],
        *[
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).alias(name)
            for sketch, name in (("date_sketch", "unique_dates"), ("station_sketch", "unique_stations"))
        ],
    )
    names = ["total_records", "unique_dates", "unique_stations", *FLAG_TOTALS]
    if exact is None:
        return totals.select(*names)
    uniques = ["unique_dates", "unique_stations"]
    counted = load_report(exact).select(*uniques)
    # Two single rows side by side, without a join.
    both = totals.drop(*uniques).unionByName(counted, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in names])


def as_landed(text: Column) -> Column:
    """Text as it reads back from CSV: without spaces around it, and NULL if nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def with_name_kind(stations: DataFrame) -> tuple[DataFrame, bool]:
    """Add ``_name``, as it lands, and ``_repeats``, whether several stations have it; and whether the
    repeated names are few enough to be held.

    Stations whose name is their own need no set: the number of names with rows is theirs.
    """
    named = stations.withColumn("_name", as_landed(F.col("station_name")))
    counts = named.where(F.col("_name").isNotNull()).groupBy("_name").agg(F.count(F.lit(1)).alias("n"))
    again = written(counts.where(F.col("n") > 1).select("_name", F.lit(True).alias("_repeats")))
    n = again.count()
    if n == 0 or n > MOST_REPEATED:
        return named.withColumn("_repeats", F.lit(False)), n == 0
    marked = null_safe_join(named, again, ["_name"], "left")
    return marked.withColumn("_repeats", F.coalesce("_repeats", F.lit(False))), True


def report_of(rows: int, totals: dict, names_once: int, names_again: list[str]) -> dict[str, int]:
    """The report of a load from what its tasks have counted: equal to ``load_report`` of its rows."""
    return {
        "total_records": rows,
        "unique_dates": len(totals["dates"]),
        "unique_stations": names_once + len(names_again),
        **{name: totals[name] for name in FLAG_TOTALS},
    }


def station_status(
    stations: DataFrame, checked: DataFrame, on: tuple[str, ...] = STATION_KEY
) -> DataFrame:
    """Each station with ``status``: ok if it has responses and all of them are ok."""
    failed = (F.col("status") == "error").cast("int")
    per_station = checked.groupBy(*on).agg(F.max(failed).alias("_failed"))
    joined = null_safe_join(stations, per_station, list(on), "left")
    return joined.select(
        *stations.columns,
        F.when(F.col("_failed") == 0, "ok").otherwise("error").alias("status"),
    )


def load_status(statuses: DataFrame) -> DataFrame:
    """One row: how many succeeded and how many failed."""
    return statuses.agg(
        F.count_if(F.col("status") == "ok").alias("successful"),
        F.count_if(F.col("status") == "error").alias("failed"),
    )
