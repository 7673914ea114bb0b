"""Queries on the given tables, each with the SQL that must give the same rows.

The tables stand in for the domain: ``lineitem`` for delays (supplier = station), ``events``
for daily weather (user = station), ``embeddings`` for the responses of the weather service
(one array per station, one element per day), ``supplier`` for the station registry and
``orders`` for arrived files.
"""

from __future__ import annotations

import importlib.util
import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dayledger.functions.casts import conform
from dayledger.functions.filenames import last_segment
from dayledger.functions.flags import flag_above, flag_outside
from dayledger.functions.zones import local_time
from dayledger.operators.arrivals import ArrivalError, newest, newest_range, with_date_range
from dayledger.operators.combine import base_plus_delta, union_counts, unified_long
from dayledger.operators.joining import null_safe_join
from dayledger.operators.local_days import daily_values, with_local_day, with_zone
from dayledger.operators.prefix import valid_prefix_rows
from dayledger.operators.report import (
    load_report,
    load_sketch,
    load_status,
    merged_report,
    station_status,
)
from dayledger.operators.series import explode_days, valid_prefix
from dayledger.plans.landing import (
    checked_series,
    every_arrival,
    every_loaded,
    initial_load,
    periodic_update,
    weather_rows,
)
from dayledger.plans.rebuild import rebuild_delays, rebuild_weather
from dayledger.schemas import DELAYS, RAW_WEATHER, WEATHER, schema_as_text
from dayledger.session import working_folder, written
from dayledger.sinks.folders import PARQUET_OPTIONS, write_folder
from dayledger.sinks.publish import NoRowsError, publish_bucketed, publish_table
from dayledger.sinks.views import create_temp_view, create_view
from dayledger.sources.registry import (
    batch_sizes,
    in_batch,
    parse_registry,
    read_registry,
    with_batch,
)
from dayledger.sources.responses import (
    accepted_lines,
    checked_lines,
    rejected_lines,
    usable,
)
from dayledger.sources.tables import days_between, file_system, read_folder, read_table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    """Register under the function's name; a trailing underscore only avoids a clash."""

    def register(function: Query) -> Query:
        name = function.__name__.rstrip("_")
        _QUERIES[name] = function
        _SQL[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- stand-ins for the inputs


def _delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("station_name"),
        F.col("l_extendedprice").alias("total_delay_minutes"),
        F.col("l_quantity").alias("train_count"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("avg_delay_minutes"),
    )


_DELAYS_SQL = """
    SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS station_name,
           l_extendedprice AS total_delay_minutes, CAST(trunc(l_quantity) AS INT) AS train_count,
           l_extendedprice / l_quantity AS avg_delay_minutes
    FROM lineitem"""


def _base_and_delta(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Together the whole table; January 2000 is in both."""
    delays = _delays(spark, sf_dir)
    return (
        delays.where(F.col("date") < F.lit("2000-02-01").cast("timestamp")),
        delays.where(F.col("date") >= F.lit("2000-01-01").cast("timestamp")),
    )


_BASE_SQL = f"{_DELAYS_SQL} WHERE l_shipdate < TIMESTAMP '2000-02-01'"
_DELTA_SQL = f"{_DELAYS_SQL} WHERE l_shipdate >= TIMESTAMP '2000-01-01'"


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, k = F.col("value"), F.col("k").cast("double")
    events = _table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return events.select(
        F.col("ts").cast("date").alias("date"),
        F.col("user_id").cast("string").alias("station_name"),
        flag_outside(value, 1.0, 147.35).alias("extreme_temperature"),
        flag_above(k, 60.0).alias("extreme_wind"),
        flag_above(value, 20.0).alias("extreme_precipitation"),
    )


_OBSERVATIONS_SQL = """
    SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS station_name,
           CASE WHEN value < 1 OR value > 147.35 THEN 1 ELSE 0 END AS extreme_temperature,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) > 60 THEN 1 ELSE 0 END
               AS extreme_wind,
           CASE WHEN value > 20 THEN 1 ELSE 0 END AS extreme_precipitation
    FROM events"""


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per vector: null days, a last series that may be too short, and a failed
    request for each vector of label 9. The vector's number is the station's position.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    days = F.size("embedding")
    daily = F.struct(
        F.transform(
            F.sequence(F.lit(0), days - 1),
            lambda i: F.date_add(F.lit("2025-06-01").cast("date"), i).cast("string"),
        ).alias("time"),
        F.transform(x, lambda v: F.when(v <= 0.36, F.floor(v * 1000) / 10)).alias(
            "temperature_2m_mean"
        ),
        F.transform(F.reverse(x), lambda v: F.floor(F.abs(v) * 2000) / 10).alias(
            "wind_gusts_10m_max"
        ),
        F.slice(
            F.transform(x, lambda v: F.floor(F.abs(v) * 1000) / 10),
            F.lit(1),
            days - F.col("label"),
        ).alias("precipitation_sum"),
    )
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("position"),
        F.concat(F.lit("S"), F.col("vec_id")).alias("station_name"),
        F.when(F.col("label") == 9, 503).otherwise(200).alias("status"),
        F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("body"),
    )
def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(_landed(spark, sf_dir))


def _entry(name: Column | None = None) -> Column:
    """A vector's registry entry; lon is numeric text."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    own = F.concat(F.lit("S"), F.col("vec_id"))
    return F.struct(
        (own if name is None else name).alias("station_name"),
        (F.floor(F.get(x, F.lit(0)) * 900000) / 10000).alias("lat"),
        (F.floor(F.get(x, F.lit(1)) * 1800000) / 10000).cast("string").alias("lon"),
    )


def _registry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry documents of 40 stations each, in the order of their vectors' numbers."""
    vectors = _table(spark, sf_dir, "embeddings").withColumn(
        "document", F.expr("vec_id div 40")
    )
    documents = vectors.groupBy("document").agg(
        F.sort_array(F.collect_list(F.struct("vec_id", _entry().alias("entry")))).alias("all")
    )
    return documents.select("document", F.to_json(F.col("all.entry")).alias("value"))


def _registry_lines(spark: SparkSession, sf_dir: str, name: Column | None = None) -> DataFrame:
    """One entry per line, in the order of the vectors' numbers, over several files."""
    # A station without a name has a name that is null, not none.
    text = F.to_json(_entry(name), {"ignoreNullFields": "false"})
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", text.alias("value"))
    return vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id").select("value")


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From documents of one station each, numbered by their vectors."""
    single = _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.to_json(F.array(_entry())).alias("value")
    )
    stations = parse_registry(single).drop("position")
    return stations.withColumn("position", F.col("vec_id").cast("int")).drop("vec_id")


# Days with their valid flag, then the rows before each station's first invalid day.
_DAYS_SQL = """
    day AS (
        SELECT vec_id, floor(embedding[1]::DOUBLE * 900000) / 10000 AS lat,
               floor(embedding[2]::DOUBLE * 1800000) / 10000 AS lon, i,
               DATE '2025-06-01' + CAST(i AS INT) AS date,
               CASE WHEN label <> 9 AND embedding[i + 1]::DOUBLE <= 0.36
                    THEN floor(embedding[i + 1]::DOUBLE * 1000) / 10 END AS t,
               floor(abs(embedding[len(embedding) - i]::DOUBLE) * 2000) / 10 AS w,
               CASE WHEN i < len(embedding) - label
                    THEN floor(abs(embedding[i + 1]::DOUBLE) * 1000) / 10 END AS p
        FROM (SELECT *, unnest(range(len(embedding))) AS i FROM embeddings)
    )"""


def _weather_sql(source: str = "day", number: str = "CAST(CAST({} AS FLOAT) AS DOUBLE)") -> str:
    n = number.format
    return f"""
    SELECT date, 'S' || vec_id AS station_name, {n('lat')} AS latitude, {n('lon')} AS longitude,
           {n('t')} AS temperature_mean_c, {n('w')} AS wind_gust_max_kmh,
           {n('p')} AS precipitation_sum_mm,
           CASE WHEN t < -15 OR t > 35 THEN 1 ELSE 0 END AS extreme_temperature,
           CASE WHEN w > 60 THEN 1 ELSE 0 END AS extreme_wind,
           CASE WHEN p > 20 THEN 1 ELSE 0 END AS extreme_precipitation
    FROM {source} AS d
    WHERE i < coalesce((SELECT min(i) FROM {source} AS b
                        WHERE b.vec_id = d.vec_id AND (b.t IS NULL OR b.p IS NULL)), 1000000)"""


# ---------------------------------------------------------------- casts and projections


@_query("""
    SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS station_name,
           o_totalprice AS total_delay_minutes, CAST(trunc(o_totalprice) AS INT) AS train_count,
           CAST(o_orderkey AS DOUBLE) AS avg_delay_minutes
    FROM orders""")
def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("string").alias("date"),
        F.col("o_custkey").alias("station_name"),
        price.alias("total_delay_minutes"),
        price.alias("train_count"),
        F.col("o_orderkey").alias("avg_delay_minutes"),
    )
    return conform(orders, DELAYS)


@_query("""
    SELECT TRY_CAST(text AS DATE) AS date, CAST(doc_id AS VARCHAR) AS station_name,
           TRY_CAST(text AS DOUBLE) AS total_delay_minutes, TRY_CAST(text AS INT) AS train_count,
           TRY_CAST(source AS DOUBLE) AS avg_delay_minutes
    FROM documents""")
def conform_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select(
        F.col("text").alias("date"),
        F.col("doc_id").alias("station_name"),
        F.col("text").alias("total_delay_minutes"),
        F.col("text").alias("train_count"),
        F.col("source").alias("avg_delay_minutes"),
    )
    return conform(documents, DELAYS)


@_query("""
    SELECT CASE o_orderkey % 4 WHEN 1 THEN NULL WHEN 3 THEN NULL
                ELSE CAST(o_orderdate AS DATE) END AS date,
           CAST(o_custkey AS VARCHAR) AS station_name,
           CASE o_orderkey % 8 WHEN 0 THEN CAST(o_custkey || '.7' AS DOUBLE)
                WHEN 2 THEN CAST(o_custkey AS DOUBLE) WHEN 3 THEN o_custkey * 1000.0::DOUBLE
                WHEN 4 THEN CAST(o_custkey || '00000000000' AS DOUBLE)
                WHEN 6 THEN CAST(-o_custkey AS DOUBLE) WHEN 7 THEN 0.5::DOUBLE END
               AS total_delay_minutes,
           CAST(CASE o_orderkey % 8 WHEN 0 THEN o_custkey WHEN 2 THEN o_custkey
                     WHEN 4 THEN CASE o_custkey WHEN 0 THEN 0 END
                     WHEN 6 THEN -o_custkey WHEN 7 THEN 0 END AS INT) AS train_count,
           CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_orderkey AS DOUBLE) END AS avg_delay_minutes
    FROM orders""")
def conform_mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad text side by side: fractions, blanks, exponents, overflow, dates."""
    number, key = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    text = F.lit(".5")
    kinds = {
        0: F.concat(number, F.lit(".7")),
        1: F.lit(""),
        2: F.concat(F.lit(" "), number, F.lit(" ")),
        3: F.concat(number, F.lit("e3")),
        4: F.concat(number, F.lit("00000000000")),
        5: F.concat(F.lit("x"), number),
        6: F.concat(F.lit("-"), number),
    }
    for kind, value in kinds.items():
        text = F.when(key % 8 == kind, value).otherwise(text)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    date = (
        F.when(key % 4 == 0, day)
        .when(key % 4 == 1, "2024-02-30")
        .when(key % 4 == 2, F.concat(day, F.lit(" 10:00:00")))
        .otherwise("no date")
    )
    orders = _table(spark, sf_dir, "orders").select(
        date.alias("Date"),
        number.alias("station_name"),
        text.alias("total_delay_minutes"),
        text.alias("TRAIN_COUNT"),
        F.when(key % 4 == 2, key.cast("string")).otherwise(F.concat(number, F.lit("?"))).alias(
            "avg_delay_minutes"
        ),
    )
    return conform(orders, DELAYS)


@_query("""
    SELECT event_id, CAST(CAST(CAST(value AS FLOAT) AS VARCHAR) AS DOUBLE) AS value
    FROM events""")
def float_narrow_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id", F.col("value").cast("float").cast("string").cast("double").alias("value")
    )


# ---------------------------------------------------------------- flags


@_query("""
    SELECT event_id, CASE WHEN value < 1 OR value > 147.35 THEN 1 ELSE 0 END
           AS extreme_temperature
    FROM events""")
def extreme_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id", flag_outside(F.col("value"), 1.0, 147.35).alias("extreme_temperature")
    )


@_query("""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_extendedprice > 90000 THEN 1 ELSE 0 END AS extreme_wind,
           CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END AS extreme_precipitation
    FROM lineitem""")
def extreme_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        flag_above(F.col("l_extendedprice"), 90000.0).alias("extreme_wind"),
        flag_above(F.col("l_quantity"), 20.0).alias("extreme_precipitation"),
    )


@_query("""
    SELECT l_quantity, CASE WHEN l_quantity < 5 OR l_quantity > 45 THEN 1 ELSE 0 END AS outside,
           CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS above, count(*) AS n
    FROM lineitem GROUP BY 1, 2, 3""")
def flag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(
            "l_quantity",
            flag_outside(quantity, 5.0, 45.0).alias("outside"),
            flag_above(quantity, 45.0).alias("above"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---------------------------------------------------------------- series and prefixes


@_query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k")
    )


@_query("""
    SELECT vec_id, label, i AS day_index, CAST(i AS VARCHAR) AS date,
           embedding[i + 1]::DOUBLE AS x
    FROM (SELECT *, CAST(unnest(range(len(embedding))) AS INT) AS i FROM embeddings)""")
def explode_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        F.transform("embedding", lambda v, i: i.cast("string")).alias("time"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    return explode_days(valid_prefix(series, ["x"]), ["x"], ["vec_id", "label"])


@_query("""
    SELECT doc_id, n_words, CASE WHEN cut = 0 THEN n_words ELSE cut - 1 END AS keep,
           CASE WHEN cut = 0 THEN 'ok' ELSE 'error' END AS status
    FROM (SELECT doc_id, CAST(len(words) AS INT) AS n_words,
                 CAST(coalesce(list_position(list_transform(words, lambda w: length(w) > 12), true),
                               0) AS INT) AS cut
          FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents))""")
def word_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each whole text as a series that ends before the first long word."""
    words = F.split("text", " ")
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id",
        words.alias("time"),
        F.transform(words, lambda w: F.when(F.length(w) <= 12, F.length(w))).alias("size"),
    )
    checked = valid_prefix(documents, ["size"])
    return checked.select("doc_id", F.size("time").alias("n_words"), "keep", "status")


@_query("""
    SELECT event_id, user_id, day, value
    FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day, value, ts,
                 min(CASE WHEN event_type = 'error' THEN ts END)
                     OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS first_bad
          FROM events)
    WHERE first_bad IS NULL OR ts < first_bad""")
def valid_prefix_(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    kept = valid_prefix_rows(events, ["user_id", "day"], "ts", F.col("event_type") == "error")
    return kept.select("event_id", "user_id", "day", "value")


@_query("""
    WITH placed AS (
        SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type = 'error' AS bad,
               CASE WHEN event_id % 5 <> 0 THEN event_id END AS place
        FROM events)
    SELECT event_id, user_id, day, place
    FROM (SELECT *, coalesce(bool_or(bad AND place IS NULL) OVER w, false) AS from_start,
                 min(CASE WHEN bad THEN place END) OVER w AS first_bad
          FROM placed WINDOW w AS (PARTITION BY user_id, day))
    WHERE NOT from_start AND (place IS NULL OR first_bad IS NULL OR place < first_bad)""")
def valid_prefix_unplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row has no position."""
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("ts").cast("date").alias("day"),
        (F.col("event_type") == "error").alias("bad"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id")).alias("place"),
    )
    return valid_prefix_rows(events, ["user_id", "day"], "place", F.col("bad")).drop("bad")


# ---------------------------------------------------------------- registry


@_query("""
    SELECT vec_id // 40 AS document,
           CAST(row_number() OVER (PARTITION BY vec_id // 40 ORDER BY vec_id) - 1 AS INT)
           AS position, 'S' || vec_id AS station_name,
           floor(embedding[1]::DOUBLE * 900000) / 10000 AS lat,
           floor(embedding[2]::DOUBLE * 1800000) / 10000 AS lon
    FROM embeddings""")
def registry_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many documents; the place in its document is a station's position."""
    return parse_registry(_registry_documents(spark, sf_dir))


@_query("""
    SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS position,
           'S' || vec_id AS station_name, floor(embedding[1]::DOUBLE * 900000) / 10000 AS lat,
           floor(embedding[2]::DOUBLE * 1800000) / 10000 AS lon,
           CAST(least((row_number() OVER (ORDER BY vec_id) - 1) // 200, 2) AS INT) AS batch
    FROM embeddings""")
def registry_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with one entry per line, numbered by many tasks, and the batch of each station."""
    registry, _, _ = _landed_files(spark, sf_dir)
    return with_batch(read_registry(spark, registry, lines=True), size=200)


@_query("""
    SELECT count(*) AS stations, count(*) FILTER (WHERE s_suppkey < 40) AS batch_0,
           count(*) FILTER (WHERE s_suppkey >= 40 AND s_suppkey < 80) AS batch_1,
           count(*) FILTER (WHERE s_suppkey >= 80) AS batch_2
    FROM supplier""")
def registry_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_sizes(_table(spark, sf_dir, "supplier"), size=40, position="s_suppkey")


@_query("""
    SELECT s_suppkey, s_name, CAST(least(s_suppkey // 40, 2) AS INT) AS batch
    FROM supplier""")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each station in the batch that slicing puts it in."""
    stations = _table(spark, sf_dir, "supplier")
    slices = in_batch(stations, 0, size=40, position="s_suppkey")
    for batch in (1, 2):
        slices = slices.union(in_batch(stations, batch, size=40, position="s_suppkey"))
    return with_batch(slices, size=40, position="s_suppkey").select("s_suppkey", "s_name", "batch")


@_query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def registry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    stations = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    return null_safe_join(lines, stations, ["l_suppkey"])


@_query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-11-23'""")
def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return days_between(orders, "o_orderdate", "1996-06-01", "1996-11-23")


# ---------------------------------------------------------------- unions and the long view


@_query(f"{_BASE_SQL} UNION ALL {_DELTA_SQL}")
def base_plus_delta_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_plus_delta(*_base_and_delta(spark, sf_dir), DELAYS)


@_query(f"""
    SELECT base_rows, delta_rows, base_rows + delta_rows AS total_rows
    FROM (SELECT count(*) AS base_rows FROM ({_BASE_SQL})),
         (SELECT count(*) AS delta_rows FROM ({_DELTA_SQL}))""")
def union_counts_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_counts(*_base_and_delta(spark, sf_dir))


_UNIFIED_SQL = f"""
    SELECT 'delay' AS data_type, date, station_name, CAST(NULL AS INT) AS extreme_temperature,
           CAST(NULL AS INT) AS extreme_wind, CAST(NULL AS INT) AS extreme_precipitation,
           total_delay_minutes, train_count, avg_delay_minutes
    FROM ({_DELAYS_SQL})
    UNION ALL
    SELECT 'weather', date, station_name, extreme_temperature, extreme_wind,
           extreme_precipitation, CAST(NULL AS DOUBLE), CAST(NULL AS INT), CAST(NULL AS DOUBLE)
    FROM ({_OBSERVATIONS_SQL})"""


@_query(_UNIFIED_SQL)
def unified_long_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified_long(conform(_delays(spark, sf_dir), DELAYS), _observations(spark, sf_dir))


@_query(f"""
    SELECT data_type, date, count(*) AS n, CAST(sum(extreme_wind) AS BIGINT) AS extreme_wind,
           CAST(sum(train_count) AS BIGINT) AS train_count
    FROM ({_UNIFIED_SQL}) GROUP BY data_type, date""")
def unified_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_temp_view(
        "unified_all", conform(_delays(spark, sf_dir), DELAYS), _observations(spark, sf_dir)
    )
    return spark.sql("""
        SELECT data_type, date, count(*) AS n, sum(extreme_wind) AS extreme_wind,
               sum(train_count) AS train_count
        FROM unified_all GROUP BY data_type, date""")


# ---------------------------------------------------------------- arrivals


@_query("""
    SELECT o_orderkey, o_orderdate FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 1""")
def latest_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return newest(orders, "o_orderdate", "o_orderkey")


@_query("""
    SELECT o_orderkey, start_date, end_date,
           coalesce(len(parts) >= 2
               AND regexp_full_match(start_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
               AND regexp_full_match(end_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
               AND try_strptime(start_date, '%Y-%m-%d') IS NOT NULL
               AND try_strptime(end_date, '%Y-%m-%d') IS NOT NULL, false) AS valid
    FROM (SELECT o_orderkey, parts, parts[1] AS start_date, parts[2] AS end_date
          FROM (SELECT o_orderkey, string_split(replace(
                    CASE left(o_orderpriority, 1)
                        WHEN '1' THEN strftime(o_orderdate, '%Y-%-m-%-d') || '_'
                                      || strftime(o_orderdate + INTERVAL 6 DAY, '%Y-%m-%d')
                        WHEN '2' THEN strftime(o_orderdate, '%Y-%m-%d')
                        WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%d') || '_'
                                      || strftime(o_orderdate, '%Y-%m-%d') || '_extra'
                        WHEN '4' THEN strftime(o_orderdate, '%Y-02-%d') || '_'
                                      || strftime(o_orderdate, '%y-%m-%d')
                        ELSE strftime(o_orderdate, '%Y-02-%d') || '_'
                             || strftime(o_orderdate, '%Y-%m-%d') END || '_delays.csv',
                    '_delays.csv', ''), '_') AS parts
                FROM orders))""")
def file_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, unpadded, short, long and impossible names, by order priority."""
    day = F.col("o_orderdate")
    full = F.date_format(day, "yyyy-MM-dd")
    later = F.date_format(F.date_add(day, 6), "yyyy-MM-dd")
    february = F.date_format(day, "yyyy-'02'-dd")
    kind = F.col("o_orderpriority").substr(1, 1)
    range_text = (
        F.when(kind == "1", F.concat_ws("_", F.date_format(day, "yyyy-M-d"), later))
        .when(kind == "2", full)
        .when(kind == "3", F.concat_ws("_", full, full, F.lit("extra")))
        .when(kind == "4", F.concat_ws("_", february, F.date_format(day, "yy-MM-dd")))
        .otherwise(F.concat_ws("_", february, full))
    )
    names = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(range_text, F.lit("_delays.csv")).alias("name")
    )
    return with_date_range(names).drop("name")


@_query("""
    SELECT page_id, string_split(url, '/')[-1] AS name, len(string_split(url, '/')) AS segments
    FROM pages""")
def last_path_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        last_segment(url).alias("name"),
        F.size(F.split(url, "/")).cast("bigint").alias("segments"),
    )


# ---------------------------------------------------------------- local days

# Zones of the stand-in stations, with whole, half and quarter hours.
_ZONES = (
    "UTC", "Europe/Budapest", "America/New_York", "Asia/Kathmandu", "Australia/Lord_Howe",
    "Pacific/Kiritimati", "America/St_Johns",
)


def _zoned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events spread over a year, so that clocks change, with their user's zone from a table."""
    later = F.make_dt_interval((F.col("event_id") % 12 * 30).cast("int"))
    events = _table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("station"), (F.col("ts") + later).alias("instant"),
        F.col("value").cast("decimal(18,4)").alias("value"),
    )
    users = events.select("station").distinct()
    zone = F.element_at(
        F.array(*map(F.lit, _ZONES)), (F.col("station") % len(_ZONES)).cast("int") + 1
    )
    return with_zone(events, users.withColumn("zone", zone), ["station"])


_ZONED_SQL = f"""
    zoned AS (
        SELECT event_id, user_id AS station, value, zone,
               timezone(zone, timezone('UTC', ts + INTERVAL (event_id % 12 * 30) DAY)) AS clock
        FROM (SELECT *, [{", ".join(f"'{z}'" for z in _ZONES)}][CAST(user_id % {len(_ZONES)} AS INT) + 1]
                     AS zone FROM events))"""


@_query(f"""
    WITH {_ZONED_SQL}
    SELECT event_id, zone, CAST(clock AS DATE) AS date,
           CAST(floor(epoch(clock - CAST(CAST(clock AS DATE) AS TIMESTAMP))) AS INT) AS seconds
    FROM zoned""")
def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local day of each event, and the time on the clock there."""
    events = with_local_day(_zoned_events(spark, sf_dir), "instant")
    return events.select(
        "event_id", "zone", "date", local_time(F.col("instant"), F.col("zone")).alias("seconds")
    )


@_query(f"""
    WITH {_ZONED_SQL}
    SELECT station, zone, CAST(clock AS DATE) AS date,
           CAST(max(value) AS DOUBLE) AS highest,
           CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) AS total,
           count(*) AS observations,
           CAST(any_value(epoch(timezone(zone, CAST(CAST(clock AS DATE) + 1 AS TIMESTAMP)))
                - epoch(timezone(zone, CAST(CAST(clock AS DATE) AS TIMESTAMP)))) / 3600 AS DOUBLE)
               AS hours
    FROM zoned GROUP BY 1, 2, 3""")
def local_day_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by station and local day, and how long each of these days is."""
    events = _zoned_events(spark, sf_dir).select(
        "station", "zone", "instant", F.col("value").alias("highest"), F.col("value").alias("total")
    )
    daily = daily_values(events, ["station"], "instant", kinds={"highest": "max", "total": "sum"})
    return daily.select(
        "station", "zone", "date", F.col("highest").cast("double").alias("highest"),
        F.col("total").cast("double").alias("total"), "observations", "hours",
    )


# ---------------------------------------------------------------- reports


@_query(f"""
    SELECT count(*) AS total_records, count(DISTINCT date) AS unique_dates,
           count(DISTINCT station_name) AS unique_stations,
           CAST(sum(extreme_temperature) AS BIGINT) AS extreme_temp_count,
           CAST(sum(extreme_wind) AS BIGINT) AS extreme_wind_count,
           CAST(sum(extreme_precipitation) AS BIGINT) AS extreme_precip_count
    FROM ({_OBSERVATIONS_SQL})""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(_observations(spark, sf_dir))


@_query("""
    SELECT count(*) FILTER (WHERE failed = 0) AS successful,
           count(*) FILTER (WHERE failed IS NULL OR failed = 1) AS failed
    FROM customer LEFT JOIN
         (SELECT user_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS failed
          FROM events GROUP BY user_id) ON c_custkey = user_id""")
def load_status_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations: failed without an event or with an error event."""
    stations = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_name"))
    events = _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("station_name"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
    )
    return load_status(station_status(stations, events, ("station_name",)))


# ---------------------------------------------------------------- whole jobs


_FROM_TEXT = "CAST(CAST(CAST({} AS FLOAT) AS VARCHAR) AS DOUBLE)"


def _landed_files(
    spark: SparkSession, sf_dir: str, name: Column | None = None
) -> tuple[str, str, str]:
    """Registry and responses as files, and a folder for what is made of them."""
    folder = working_folder(spark)
    _registry_lines(spark, sf_dir, name).write.text(f"{folder}/registry")
    _landed(spark, sf_dir).write.json(f"{folder}/responses")
    return f"{folder}/registry", f"{folder}/responses", f"{folder}/made"


def _arrivals(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The newest order names the newest file; an older one lies beside it."""
    first_day = F.date_add(F.lit("2025-06-01").cast("date"), (F.col("o_custkey") % 40).cast("int"))
    name = F.concat_ws("_", first_day, F.date_add(first_day, 13), F.lit("delays.csv"))
    manifest = _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("modificationTime"),
        F.col("o_orderkey").alias("path"),
        name.alias("name"),
    )
    for k, file in enumerate(("2025-01-01_2025-01-07_delays.csv", newest(manifest).first()["name"])):
        place, files = file_system(spark, f"{folder}/arrivals/{file}")
        files.create(place).close()
        files.setTimes(place, 1_000_000_000_000 + 1000 * k, -1)
    return f"{folder}/arrivals"


def _once(prefix: str) -> str:
    """A table name for this run only."""
    return f"{prefix}_{uuid.uuid4().hex}"


def _dropped(spark: SparkSession, result: DataFrame, *names: str) -> DataFrame:
    """The files stay; the names, made up for this run, need not."""
    result.schema  # noqa: B018  analysed while the names are there
    for name in names:
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")
    return result


@_query(f"WITH {_DAYS_SQL} {_weather_sql('day', _FROM_TEXT)}")
def weather_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill job: registry and responses from files to a published table."""
    registry, responses, made = _landed_files(spark, sf_dir)
    table = _once("weather_initial")
    initial_load(spark, registry, responses, made, table=table, registry_lines=True)
    return _dropped(spark, conform(read_table(spark, table), WEATHER), table)


_NEWEST_SQL = """
    newest AS (
        SELECT DATE '2025-06-01' + CAST(o_custkey % 40 AS INT) AS first_day
        FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1
    ),
    ranged AS (
        SELECT day.* FROM day, newest WHERE date BETWEEN first_day AND first_day + 13
    )"""


@_query(f"WITH {_DAYS_SQL}, {_NEWEST_SQL} {_weather_sql('ranged', _FROM_TEXT)}")
def weather_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic job for the date range in the name of the newest file."""
    registry, responses, made = _landed_files(spark, sf_dir)
    arrivals = _arrivals(spark, sf_dir, made)
    table = _once("weather_last_week")
    periodic_update(spark, arrivals, registry, responses, made, table=table, registry_lines=True)
    return _dropped(spark, conform(read_table(spark, table), WEATHER), table)


@_query(f"WITH {_DAYS_SQL}, {_NEWEST_SQL} {_weather_sql('ranged', _FROM_TEXT)}")
def update_all_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic job into a folder, with a registry of several batches."""
    registry, responses, made = _landed_files(spark, sf_dir)
    arrivals = _arrivals(spark, sf_dir, made)
    periodic_update(
        spark, arrivals, registry, responses, f"{made}/out", batch_size=100, registry_lines=True
    )
    landed = read_folder(spark, f"{made}/out", "csv", schema_as_text(RAW_WEATHER))
    return conform(landed, WEATHER)


_EVERY_SQL = """
    arrival AS (
        SELECT row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS k,
               DATE '2025-06-01' + CAST(o_custkey % 50 AS INT) AS first_day
        FROM orders QUALIFY k <= 4
    ),
    first_load AS (
        SELECT * FROM day WHERE EXISTS (
            FROM arrival WHERE k = 1 AND date BETWEEN first_day AND first_day + 5)
    ),
    second_load AS (
        SELECT * FROM day WHERE EXISTS (
            FROM arrival WHERE k > 1 AND date BETWEEN first_day AND first_day + 5)
        AND NOT EXISTS (FROM arrival WHERE k = 1 AND date BETWEEN first_day AND first_day + 5)
    )"""


@_query(f"""
    WITH {_DAYS_SQL}, {_EVERY_SQL}
    {_weather_sql('first_load', _FROM_TEXT)} UNION ALL {_weather_sql('second_load', _FROM_TEXT)}""")
def arrivals_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file, then three between two runs, then none: each day of all four loaded once.

    The files' names are those of the four newest orders.
    """
    registry, responses, made = _landed_files(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(4)
    first_day = F.date_add(F.lit("2025-06-01").cast("date"), (F.col("o_custkey") % 50).cast("int"))
    name = F.concat_ws("_", first_day, F.date_add(first_day, 5), F.col("o_orderkey"), F.lit("delays.csv"))
    names = [r["name"] for r in orders.select("o_orderdate", "o_orderkey", name.alias("name"))
             .orderBy(F.desc("o_orderdate"), "o_orderkey").collect()]
    for arrived in (names[:1], names[1:], []):
        for file in arrived:
            place, files = file_system(spark, f"{made}/arrivals/{file}")
            files.create(place).close()
        every_arrival(
            spark, f"{made}/arrivals", registry, responses, f"{made}/out", registry_lines=True
        )
    return conform(every_loaded(spark, f"{made}/out"), WEATHER)


@_query(f"""
    WITH {_DAYS_SQL}, {_NEWEST_SQL}
    {_weather_sql('day', _FROM_TEXT)} UNION ALL {_weather_sql('ranged', _FROM_TEXT)}""")
def weather_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads, then the rebuild of the table and the view over it."""
    registry, responses, made = _landed_files(spark, sf_dir)
    base, delta, delays, target, view = map(
        _once, ("weather_initial", "weather_last_week", "delays_all", "weather_all", "unified_all")
    )
    initial_load(spark, registry, responses, made, table=base, registry_lines=True)
    arrivals = _arrivals(spark, sf_dir, made)
    periodic_update(spark, arrivals, registry, responses, made, table=delta, registry_lines=True)
    publish_table(conform(_base_and_delta(spark, sf_dir)[1], DELAYS), delays, made, "csv")
    rebuild_weather(spark, made, base, delta, target, delays, view)
    return _dropped(spark, read_table(spark, target), view, target, delays, base, delta)


def _delays_tables(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    """Base and delta as published CSV tables."""
    names = _once("delays_initial"), _once("delays_last_week")
    for rows, name in zip(_base_and_delta(spark, sf_dir), names, strict=True):
        publish_table(conform(rows, DELAYS), name, root, "csv")
    return names


@_query(f"{_BASE_SQL} UNION ALL {_DELTA_SQL}")
def delays_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark)
    base, delta = _delays_tables(spark, sf_dir, root)
    target = _once("delays_all")
    rebuild_delays(spark, root, base, delta, target)
    return _dropped(spark, read_table(spark, target), target, base, delta)


@_query(f"{_BASE_SQL} UNION ALL {_DELTA_SQL}")
def rebuild_after_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuilt twice; files with rows of 1998 and later come to the base's folder in between, by
    hand. The second rebuild reads these files alone.
    """
    root = working_folder(spark)
    base, delta = conform(_base_and_delta(spark, sf_dir)[0], DELAYS), _once("delays_last_week")
    late = F.col("date") >= F.lit("1998-01-01").cast("date")
    write_folder(base.where(~late), f"{root}/base", "csv")
    table, target = _once("delays_initial"), _once("delays_all")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DELAYS.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING csv OPTIONS (header 'true') "
              f"LOCATION '{root}/base'")  # fmt: skip
    publish_table(conform(_base_and_delta(spark, sf_dir)[1], DELAYS), delta, root, "csv")
    rebuild_delays(spark, root, table, delta, target, by_file=True)
    write_folder(base.where(late), f"{root}/late", "csv")
    place, files = file_system(spark, f"{root}/base")
    for status in files.listStatus(file_system(spark, f"{root}/late")[0]):
        if status.getPath().getName().startswith("part-"):
            files.rename(status.getPath(), place)
    rebuild_delays(spark, root, table, delta, target, by_file=True)
    return _dropped(spark, read_table(spark, target), target, table, delta)


@_query("""
    SELECT CAST(c_custkey AS VARCHAR) AS station_name, c_name || ', "' || c_mktsegment || '"'
               AS label,
           c_acctbal AS value
    FROM customer""")
def publish_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with comma and quotes through CSV, in as few files as the size allows."""
    folder = working_folder(spark)
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    rows = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("station_name"),
        label.alias("label"),
        F.col("c_acctbal").alias("value"),
    )
    write_folder(rows, folder, "csv", "auto")
    return read_folder(spark, folder, "csv", rows.schema)


@_query(_OBSERVATIONS_SQL)
def publish_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written together."""
    folder = working_folder(spark)
    rows = _observations(spark, sf_dir)
    write_folder(rows, folder, "parquet", cluster_by=("date",))
    return read_folder(spark, folder, "parquet", rows.schema)


@_query(f"""
    SELECT 'day' AS asked, * FROM ({_OBSERVATIONS_SQL})
    WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
    UNION ALL SELECT 'station', * FROM ({_OBSERVATIONS_SQL}) WHERE station_name = '7'""")
def skipping_by_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laid out by day and station together, without dictionaries; then asked by either column."""
    folder = working_folder(spark)
    rows = _observations(spark, sf_dir)
    write_folder(rows, folder, "parquet", 32, z_order=("date", "station_name"), **PARQUET_OPTIONS)
    landed = read_folder(spark, folder, "parquet", rows.schema)
    days = landed.where(F.col("date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date")))
    station = landed.where(F.col("station_name") == "7")
    return days.select(F.lit("day").alias("asked"), "*").union(
        station.select(F.lit("station").alias("asked"), "*")
    )


@_query("""
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stations and their orders in buckets of the same key; the orders published twice."""
    root = working_folder(spark)
    stations, rows = _once("stations_bucketed"), _once("rows_bucketed")
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("station"), "c_name", "c_mktsegment"
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station"), "o_orderkey", "o_totalprice"
    )
    publish_bucketed(customers, stations, root, ("station",), 8)
    publish_bucketed(orders.where("o_orderkey % 2 = 0"), rows, root, ("station",), 8)
    publish_bucketed(orders, rows, root, ("station",), 8)
    joined = read_table(spark, rows).join(read_table(spark, stations).hint("merge"), "station")
    result = joined.select(
        "o_orderkey", F.col("station").alias("o_custkey"), "c_name", "c_mktsegment", "o_totalprice"
    )
    return _dropped(spark, result, stations, rows)


@_query("""
    SELECT true AS few_files, count(*) AS orders, min(o_orderkey) AS first, max(o_orderkey) AS last,
           CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM orders""")
def number_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published in three files at most."""
    folder = working_folder(spark)
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    write_folder(rows, folder, "csv", 3)
    landed = read_folder(spark, folder, "csv", rows.schema).select(
        "o_orderkey", F.col("_metadata.file_name").alias("file")
    )
    return landed.agg(
        (F.count_distinct("file") <= 3).alias("few_files"),
        F.count(F.lit(1)).alias("orders"),
        F.min("o_orderkey").alias("first"),
        F.max("o_orderkey").alias("last"),
        F.sum("o_orderkey").alias("keys"),
    )


_PUBLISHED_SQL = _UNIFIED_SQL.replace(
    f"({_DELAYS_SQL})", f"({_BASE_SQL} UNION ALL {_DELTA_SQL})"
)


@_query(f"""
    SELECT data_type, station_name, count(*) AS n, min(date) AS first_date, max(date) AS last_date,
           CAST(sum(extreme_wind) AS BIGINT) AS extreme_wind,
           CAST(sum(train_count) AS BIGINT) AS train_count
    FROM ({_PUBLISHED_SQL}) GROUP BY data_type, station_name""")
def published_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables published twice, the second time from themselves, under a stored view."""
    root = working_folder(spark)
    name = root.rsplit("-", 1)[-1]
    delays, weather, view = f"delays_{name}", f"weather_{name}", f"unified_{name}"
    base, delta = _base_and_delta(spark, sf_dir)
    publish_table(conform(base, DELAYS), delays, root, "csv")
    published = spark.table(delays)
    publish_table(
        base_plus_delta(published, delta.select(*published.columns), DELAYS), delays, root, "csv"
    )
    publish_table(_observations(spark, sf_dir), weather, root, "parquet")
    create_view(spark, view, delays, weather)
    long = spark.table(view)
    result = long.groupBy("data_type", "station_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("extreme_wind").alias("extreme_wind"),
        F.sum("train_count").alias("train_count"),
    )
    # The files stay; the names, made up for this run, need not.
    spark.sql(f"DROP VIEW {view}")
    spark.sql(f"DROP TABLE {delays}")
    spark.sql(f"DROP TABLE {weather}")
    return result


@_query(f"""
    SELECT count(*) AS total_records, true AS near_dates, true AS near_stations,
           count(DISTINCT date) AS unique_dates, count(DISTINCT station_name) AS unique_stations,
           CAST(sum(extreme_wind) AS BIGINT) AS extreme_wind_count
    FROM ({_OBSERVATIONS_SQL})""")
def merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of three loads merged: totals exact, distinct days and stations within 2 %."""
    rows = _observations(spark, sf_dir)
    loads = [rows.where(F.pmod(F.xxhash64("station_name", "date"), F.lit(3)) == k) for k in range(3)]
    sketches = written(reduce(DataFrame.union, map(load_sketch, loads)))
    near = merged_report(sketches).withColumnsRenamed(
        {"unique_dates": "d", "unique_stations": "s"}
    )
    exact = merged_report(sketches, exact=rows)
    names = [*exact.columns, "d", "s"]
    both = exact.unionByName(near.select("d", "s"), allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in names]
    )

    def close(estimate: str, value: str) -> Column:
        return F.abs(F.col(estimate) - F.col(value)) <= 0.02 * F.col(value)

    return both.select(
        "total_records", close("d", "unique_dates").alias("near_dates"),
        close("s", "unique_stations").alias("near_stations"), "unique_dates", "unique_stations",
        "extreme_wind_count",
    )


@_query(f"""
    WITH {_DAYS_SQL}, loaded AS ({_weather_sql()})
    SELECT count(*) AS total_records, count(DISTINCT date) AS unique_dates,
           count(DISTINCT station_name) AS unique_stations,
           CAST(sum(extreme_temperature) AS BIGINT) AS extreme_temp_count,
           CAST(sum(extreme_wind) AS BIGINT) AS extreme_wind_count,
           CAST(sum(extreme_precipitation) AS BIGINT) AS extreme_precip_count
    FROM loaded""")
def weather_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = checked_series(_stations(spark, sf_dir), _responses(spark, sf_dir))
    return load_report(weather_rows(checked))


@_query(f"""
    WITH {_DAYS_SQL}, station AS (
        SELECT vec_id, max(CASE WHEN t IS NULL OR p IS NULL THEN 1 ELSE 0 END) AS failed
        FROM day GROUP BY vec_id)
    SELECT count(*) FILTER (WHERE failed = 0) AS successful,
           count(*) FILTER (WHERE failed = 1) AS failed,
           (SELECT count(*) FROM ({_weather_sql()})) AS total_records
    FROM station""")
def load_outcome_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own report: names repeat or are missing, every third response landed twice."""
    vec_id = F.col("vec_id")
    name = F.when(vec_id % 7 != 0, F.concat(F.lit("S"), vec_id % 50))
    registry, responses, made = _landed_files(spark, sf_dir, name)
    again = _landed(spark, sf_dir).where(F.col("position") % 3 == 0)
    again.write.mode("append").json(responses)
    report = initial_load(spark, registry, responses, f"{made}/out", registry_lines=True)
    return spark.range(1).select(
        *(F.lit(report[c]).cast("long").alias(c) for c in ("successful", "failed", "total_records"))
    )


@_query("""
    SELECT 'used' AS reason, count(*) AS lines FROM embeddings
    UNION ALL SELECT CASE o_orderstatus WHEN 'F' THEN 'a field of another type'
                          WHEN 'O' THEN 'not an object' ELSE 'not JSON' END, count(*)
              FROM orders GROUP BY 1
    UNION ALL SELECT 'no key', count(*) FROM events
    UNION ALL SELECT 'no status and no body', count(*) FROM supplier""")
def response_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good responses among lines that are none: each line is used or rejected with its reason."""
    folder = working_folder(spark)
    order, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    bad = _table(spark, sf_dir, "orders").select(
        F.when(status == "F", F.format_string('{"position": "x%s", "status": 200}', order))
        .when(status == "O", F.format_string("[%s]", order))
        .otherwise(F.format_string('{"position": %s', order))
        .alias("value")
    )
    bare = _table(spark, sf_dir, "supplier").select(
        F.to_json(F.struct(F.col("s_suppkey").alias("position"))).alias("value")
    )
    keyless = _table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    good = _landed(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    reduce(DataFrame.union, (good, bad, bare, keyless)).write.text(folder)
    lines = checked_lines(spark, folder)
    turned_away = rejected_lines(lines).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    used = accepted_lines(lines).agg(F.count(F.lit(1)).alias("lines"))
    return used.select(F.lit("used").alias("reason"), "lines").union(turned_away)


@_query("""
    SELECT status AS listing, count(o_orderkey) = 0 AS refused,
           CASE WHEN count(o_orderkey) = 0 THEN 'no file has arrived'
                ELSE strftime(arg_max(o_orderdate, {'t': o_orderdate, 'k': -o_orderkey}), '%Y-%m-%d') END
               AS answer
    FROM (SELECT unnest(['F', 'O', 'P', 'none']) AS status) LEFT JOIN orders ON o_orderstatus = status
    GROUP BY status""")
def refused_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as arrived files, by status: the newest one's first day, or that none has arrived."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    listing = _table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("modificationTime"),
        F.col("o_orderkey").alias("path"), F.concat_ws("_", day, day, F.lit("delays.csv")).alias("name"),
    )
    rows = []
    for status in ("F", "O", "P", "none"):
        try:
            answer = newest_range(listing.where(F.col("status") == status))[0]
            rows.append((status, False, answer))
        except ArrivalError as refusal:
            rows.append((status, True, str(refusal)))
    return spark.createDataFrame(rows, "listing string, refused boolean, answer string")


@_query(f"""
    WITH {_DAYS_SQL},
    loaded AS ({_weather_sql()}),
    stations AS (SELECT vec_id, 'S' || vec_id AS station_name, label = 9 AS failing FROM embeddings)
    SELECT failing, count(l.date) = 0 AS refused, count(l.date) AS total_records
    FROM stations LEFT JOIN loaded l USING (station_name) GROUP BY failing""")
def refused_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load publishes nothing where every request has failed, and the earlier rows stay."""
    registry, responses, made = _landed_files(spark, sf_dir)
    labels = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("position"), "label"
    )
    stations = read_registry(spark, registry, lines=True).join(labels, "position")
    rows = []
    for failing in (False, True):
        some = stations.where((F.col("label") == 9) == failing).drop("label")
        try:
            report = initial_load(spark, some, responses, f"{made}/out")
            rows.append((failing, False, report["total_records"]))
        except NoRowsError:
            rows.append((failing, True, 0))
    landed = read_folder(spark, f"{made}/out", "csv", schema_as_text(RAW_WEATHER)).count()
    assert landed == rows[0][2]
    return spark.createDataFrame(rows, "failing boolean, refused boolean, total_records long")


@_query(f"""
    WITH {_DAYS_SQL}, station AS (
        SELECT vec_id, max(CASE WHEN t IS NULL OR p IS NULL THEN 1 ELSE 0 END) AS failed
        FROM day GROUP BY vec_id)
    SELECT count(*) FILTER (WHERE failed = 0) AS successful,
           count(*) FILTER (WHERE failed = 1) AS failed
    FROM station""")
def weather_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = _stations(spark, sf_dir)
    checked = checked_series(stations, _responses(spark, sf_dir))
    return load_status(station_status(stations, checked))


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """The long table of delays and weather."""
    return unified_long_(spark, "/root/testdata/sf0.001")


def _is_there(module: str) -> bool:
    """Whether the file is there; an error while it is imported still shows."""
    return importlib.util.find_spec(module) is not None


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """The operators for training data and their pipeline, where they are installed."""
    found: dict[str, Query] = {}
    sql: dict[str, str] = {}
    if _is_there("dayledger.llm"):
        from dayledger.llm import queries as llm

        found |= llm.QUERIES
        sql |= llm.SQL
        # The pipeline is made of these operators: without them it is left out, too.
        if _is_there("corpus_pipeline"):
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return _QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return _SQL | _training_data()[1]
