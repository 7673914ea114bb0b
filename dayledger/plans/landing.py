"""Land daily weather: stations and responses to typed, flagged rows."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from dayledger.functions.flags import flag_above, flag_outside
from dayledger.functions.ranges import Range, without
from dayledger.operators.arrivals import newest_range
from dayledger.operators.pairing import STATION_KEY, pair
from dayledger.operators.report import (
    FLAG_TOTALS,
    load_report,
    report_of,
    row_totals,
    sketch_totals,
    with_name_kind,
)
from dayledger.operators.series import explode_days, in_range, parse_daily, valid_prefix
from dayledger.schemas import (
    BATCH_SIZE,
    DAILY_SERIES,
    LAST_BATCH,
    RAW_WEATHER,
    Thresholds,
    schema_as_text,
)
from dayledger.sinks.folders import Totals, discard_folder, replace_folder, write_folder
from dayledger.sinks.publish import NoRowsError, publish_table
from dayledger.sources import ledger as ledgers
from dayledger.sources.registry import in_batch, read_registry, with_batch
from dayledger.sources.responses import (
    accepted_lines,
    checked_lines,
    read_responses,
    rejected_lines,
)
from dayledger.sources.tables import file_system, list_folder, read_folder

log = logging.getLogger(__name__)

MEASURES = list(DAILY_SERIES.values())


def checked_series(
    stations: DataFrame,
    responses: DataFrame,
    start: str | None = None,
    end: str | None = None,
    on: tuple[str, ...] = STATION_KEY,
    ranges: list[Range] | None = None,
) -> DataFrame:
    """One row per station that has a response: its series, ``keep`` and ``status``."""
    paired = pair(stations, responses, on)
    return valid_prefix(
        parse_daily(paired), MEASURES, ("lat", "lon"), start, end, ranges=ranges
    )


def weather_rows(
    checked: DataFrame,
    start: str | None = None,
    end: str | None = None,
    thresholds: Thresholds = Thresholds(),
    extra: tuple[str, ...] = (),
    ranges: list[Range] | None = None,
) -> DataFrame:
    """Raw weather rows. Flags come from the doubles, narrowing to float comes last."""
    carry = ["station_name", "lat", "lon", *extra]
    days = explode_days(checked, MEASURES, carry, start, end, ranges=ranges)
    values = {
        "latitude": F.col("lat"),
        "longitude": F.col("lon"),
        "extreme_temperature": flag_outside(
            F.col("temperature_mean_c"), thresholds.temperature_low, thresholds.temperature_high
        ),
        "extreme_wind": flag_above(F.col("wind_gust_max_kmh"), thresholds.wind_high),
        "extreme_precipitation": flag_above(
            F.col("precipitation_sum_mm"), thresholds.precipitation_high
        ),
    }
    return days.select(
        *[
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in RAW_WEATHER.fields
        ],
        *extra,
    )


def land(
    stations: DataFrame,
    responses: DataFrame,
    output: str,
    start: str | None,
    end: str | None,
    files: int | str | None = None,
    thresholds: Thresholds = Thresholds(),
    on: tuple[str, ...] = STATION_KEY,
    partition_by: tuple[str, ...] = (),
    table: str | None = None,
    ranges: list[Range] | None = None,
    sketches: str | None = None,
) -> dict[str, int]:
    """Write the raw rows as CSV and return the report.

    The output is a folder to replace, with a subfolder per value of the ``partition_by``
    columns of the stations. With ``table`` it is the root below which that table is published.
    Either way rows are written to a new place first, so a failed or empty run leaves the
    earlier ones.

    The report is made by the writing pass itself: rows, flags and the set of days by the tasks that
    write, stations by those that parse. So nothing is read again; only where the number of files
    asks for a shuffle are the stations looked through once more, as tasks below a shuffle may run
    twice, and the rows only if more names belong to several stations than a set may hold. A station without a response counts as failed. Days outside the range are counted, too.
    """
    spark = stations.sparkSession
    named, few = with_name_kind(stations)
    checked = checked_series(named, responses, start, end, on, ranges)
    status = [
        F.count_if(F.col("status") == "ok").alias("successful"),
        F.coalesce(F.sum(_left_out(start, end, ranges)), F.lit(0)).alias("days_left_out"),
        *_stations_with_rows(start, end, ranges),
    ]
    outcome = None
    if files is None:
        outcome = Observation()
        checked = checked.observe(outcome, *status)
    rows = weather_rows(checked, start, end, thresholds, partition_by, ranges)
    text = schema_as_text(RAW_WEATHER)
    totals = Totals(*row_totals(), *(sketch_totals() if sketches else ()))
    if table:
        written = publish_table(
            rows, table, output, "csv", files, read_schema=text, require_rows=True, totals=totals
        )
    else:
        staged = f"{output.rstrip('/')}._new-{uuid.uuid4().hex}"
        try:
            written = write_folder(
                rows, staged, "csv", files, partition_by=partition_by, totals=totals
            )
            if written == 0:
                raise NoRowsError("no weather data, nothing written")
            replace_folder(spark, staged, output)
        except Exception:
            discard_folder(spark, staged)
            raise

    counted = outcome.get if outcome else checked.agg(*status).first().asDict()
    successful = counted["successful"]
    report = {
        "successful": successful,
        "failed": stations.count() - successful,
        "days_left_out": counted["days_left_out"],
        **report_of(written, totals.values, counted["names_once"], counted["names_again"]),
    }
    if not few:
        landed = spark.table(table) if table else read_folder(spark, output, "csv", text)
        report["unique_stations"] = load_report(landed).first()["unique_stations"]
    if sketches:
        _store_sketch(spark, sketches, report, totals.values)
    log.info("loaded %s: %s", output, report)
    return report


def _store_sketch(spark: SparkSession, folder: str, report: dict, totals: dict) -> None:
    """Add a load's row to the folder of sketches, where ``merged_report`` finds it."""
    kinds = {"total_records": "long", **dict.fromkeys(FLAG_TOTALS, "long")}
    kinds |= {"date_sketch": "binary", "station_sketch": "binary"}
    row = [report[c] if c in report else bytes(totals[c]) for c in kinds]
    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)


def _stations_with_rows(
    start: str | None, end: str | None, ranges: list[Range] | None
) -> list[Column]:
    """How many stations with a name of their own have rows, and the other names that have any."""
    days = F.slice("time", 1, F.col("keep"))
    there = F.exists(days, lambda day: in_range(day, start, end, ranges))
    named = F.coalesce(there, F.lit(False)) & F.col("_name").isNotNull()
    again = F.col("_repeats")
    return [
        F.count_if(named & ~again).alias("names_once"),
        F.collect_set(F.when(named & again, F.col("_name"))).alias("names_again"),
    ]


def _left_out(start: str | None, end: str | None, ranges: list[Range] | None) -> Column:
    """Days of a station's series outside the range."""
    if start is None and end is None and ranges is None:
        return F.lit(0)
    outside = F.filter("time", lambda day: ~in_range(day, start, end, ranges))
    return F.when(F.col("time").isNotNull(), F.size(outside))


def _registry(spark: SparkSession, registry: str | DataFrame, lines: bool) -> DataFrame:
    """A document's path, that of files of lines, or a table with position, station_name, lat, lon."""
    return read_registry(spark, registry, lines) if isinstance(registry, str) else registry


def initial_load(
    spark: SparkSession,
    registry: str | DataFrame,
    responses: str,
    output: str,
    batch: int | None = None,
    start: str | None = None,
    end: str | None = None,
    files: int | str | None = None,
    responses_format: str = "json",
    thresholds: Thresholds = Thresholds(),
    on: tuple[str, ...] = STATION_KEY,
    batch_size: int = BATCH_SIZE,
    last_batch: int = LAST_BATCH,
    table: str | None = None,
    registry_lines: bool = False,
    ranges: list[Range] | None = None,
    sketches: str | None = None,
    rejected: str | None = None,
) -> dict[str, int]:
    """Load all stations and all landed days: as one table, or as a folder with a subfolder per
    batch. A batch or dates, if given, leave the others out, and the report says how many.

    The registry is a document's path, with ``registry_lines`` that of files with one entry per
    line, or a table of stations. ``sketches`` is a folder to which the load adds a row that can be
    merged with those of other loads; ``rejected`` one to which it writes the lines of JSON responses
    that can't be used, with the reason.
    """
    stations = everyone = _registry(spark, registry, registry_lines)
    partition_by = ()
    if batch is not None:
        stations = in_batch(stations, batch, batch_size, last_batch)
    elif not table:
        stations = with_batch(stations, batch_size, last_batch)
        partition_by = ("batch",)
    if rejected:
        if responses_format != "json":
            raise ValueError("only lines of JSON can be rejected")
        lines = checked_lines(spark, responses, on)
        rejects = rejected_lines(lines)
        turned_away = write_folder(rejects, rejected, "json")
        landed = accepted_lines(lines, on)
    else:
        landed = read_responses(spark, responses, responses_format, on)
    report = land(
        stations, landed, output, start, end, files, thresholds, on, partition_by, table, ranges,
        sketches,
    )
    left_out = 0
    if batch is not None:
        left_out = everyone.select("position").count() - report["successful"] - report["failed"]
    report["stations_left_out"] = left_out
    return {**report, "rejected": turned_away} if rejected else report


def periodic_update(
    spark: SparkSession,
    arrivals: str,
    registry: str | DataFrame,
    responses: str,
    output: str,
    batch: int | None = None,
    **options,
) -> dict[str, int]:
    """Load the date range named by the newest arrived file, for all stations unless told.

    Takes the options of ``initial_load`` but for the dates.
    """
    start, end = newest_range(list_folder(spark, arrivals))
    return initial_load(spark, registry, responses, output, batch, start, end, **options)


def every_arrival(
    spark: SparkSession,
    arrivals: str,
    registry: str | DataFrame,
    responses: str,
    output: str,
    ledger: str | None = None,
    **options,
) -> dict:
    """Load the days of all files that have arrived since the last run, each day once.

    Takes the options of ``initial_load`` but for dates, a batch and a table. However many files lie
    between two runs, their days are one load: one pass over the responses, one folder below
    ``output``. A day that an earlier load has is not loaded again. The load counts when it stands
    in the ledger (``output/_ledger`` unless told); a run that fails before loads the same files
    again next time, into the same folder. ``every_loaded`` reads what counts.

    The report has ``files``, the number of files now loaded, ``load``, and ``unreadable``, the files
    whose names hold no date range. Without any new day nothing is written but the ledger's entry.
    """
    ledger = ledger or f"{output.rstrip('/')}/_ledger"
    found = ledgers.pending(spark, list_folder(spark, arrivals), ledger)
    report = {"files": len(found.arrivals), "load": None, "unreadable": found.unreadable}
    if not found.arrivals:
        return report
    days = without([a.days for a in found.arrivals], ledgers.loaded_days(spark, ledger))
    if days:
        folder = f"{output.rstrip('/')}/load-{found.load}"
        report |= initial_load(spark, registry, responses, folder, ranges=days, **options)
    ledgers.commit(spark, ledger, found, report)
    return {**report, "load": found.load}


def every_loaded(spark: SparkSession, output: str, ledger: str | None = None) -> DataFrame:
    """The rows of all loads in the ledger; folders of runs that failed are not looked at."""
    root = output.rstrip("/")
    folders = [f"{root}/load-{load}" for load in ledgers.loads(spark, ledger or f"{root}/_ledger")]
    _, files = file_system(spark, root)
    there = [f for f in folders if files.exists(file_system(spark, f)[0])]
    text = schema_as_text(RAW_WEATHER)
    if not there:
        return spark.createDataFrame([], text)
    rows = spark.read.schema(text).options(header="true", recursiveFileLookup="true")
    return rows.csv(there)
