"""Table schemas and the fixed values of the weather preset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Column names, order and types of the tables.
RAW_WEATHER = _struct(
    ("date", T.StringType()),
    ("station_name", T.StringType()),
    ("latitude", T.FloatType()),
    ("longitude", T.FloatType()),
    ("temperature_mean_c", T.FloatType()),
    ("wind_gust_max_kmh", T.FloatType()),
    ("precipitation_sum_mm", T.FloatType()),
    ("extreme_temperature", T.IntegerType()),
    ("extreme_wind", T.IntegerType()),
    ("extreme_precipitation", T.IntegerType()),
)

WEATHER = _struct(
    ("date", T.DateType()),
    ("station_name", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("temperature_mean_c", T.DoubleType()),
    ("wind_gust_max_kmh", T.DoubleType()),
    ("precipitation_sum_mm", T.DoubleType()),
    ("extreme_temperature", T.IntegerType()),
    ("extreme_wind", T.IntegerType()),
    ("extreme_precipitation", T.IntegerType()),
)

DELAYS = _struct(
    ("date", T.DateType()),
    ("station_name", T.StringType()),
    ("total_delay_minutes", T.DoubleType()),
    ("train_count", T.IntegerType()),
    ("avg_delay_minutes", T.DoubleType()),
)

UNIFIED = _struct(
    ("data_type", T.StringType()),
    ("date", T.DateType()),
    ("station_name", T.StringType()),
    ("extreme_temperature", T.IntegerType()),
    ("extreme_wind", T.IntegerType()),
    ("extreme_precipitation", T.IntegerType()),
    ("total_delay_minutes", T.DoubleType()),
    ("train_count", T.IntegerType()),
    ("avg_delay_minutes", T.DoubleType()),
)

RESPONSES = _struct(
    ("position", T.IntegerType()),
    ("station_name", T.StringType()),
    ("status", T.IntegerType()),
    ("body", T.StringType()),
)

# Series of the daily response, and the columns they land in.
DAILY_SERIES = {
    "temperature_2m_mean": "temperature_mean_c",
    "wind_gusts_10m_max": "wind_gust_max_kmh",
    "precipitation_sum": "precipitation_sum_mm",
}

# Stations per batch, last batch.
BATCH_SIZE = 900
LAST_BATCH = 2

# Fixed value: end of an arrival's file name.
ARRIVAL_SUFFIX = "_delays.csv"


@dataclass(frozen=True)
class Thresholds:
    """A value is extreme strictly beyond its bound; the bound itself is not."""

    # Degrees C, km/h, mm.
    temperature_low: float = -15.0
    temperature_high: float = 35.0
    wind_high: float = 60.0
    precipitation_high: float = 20.0


def schema_as_text(kinds: T.StructType) -> T.StructType:
    """The same columns as they are read back from text: wide, dates still text."""
    wide = {T.FloatType(): T.DoubleType()}
    return T.StructType(
        [T.StructField(f.name, wide.get(f.dataType, f.dataType), True) for f in kinds]
    )
