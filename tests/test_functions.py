"""Casts, flags and file names on hand-made values."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dayledger.functions.casts import conform, lenient_cast
from dayledger.functions.filenames import date_range, last_segment
from dayledger.functions.flags import flag_above, flag_outside
from dayledger.schemas import DELAYS, WEATHER, Thresholds


def _value(spark, kind, value, function):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(function(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, flag",
    [(-15.0, 0), (-15.01, 1), (35.0, 0), (35.01, 1), (35.0000001, 1), (float("nan"), 0),
     (float("inf"), 1), (float("-inf"), 1), (0.0, 0)],
)
def test_flag_outside(spark, value, flag):
    t = Thresholds()
    low, high = t.temperature_low, t.temperature_high
    assert _value(spark, "double", value, lambda v: flag_outside(v, low, high)) == flag


@pytest.mark.parametrize(
    "high, value, flag",
    [(60, 60.0, 0), (60, 60.01, 1), (20, 20.0, 0), (20, 20.01, 1), (20, float("nan"), 0)],
)
def test_flag_above(spark, high, value, flag):
    assert _value(spark, "double", value, lambda v: flag_above(v, high)) == flag


TEXT_INTS = [
    ("12", 12), ("12.7", 12), ("-12.7", -12), ("+3", 3), (" 5 ", 5), ("5.", 5), ("abc", None),
    ("", None), ("1e3", None), ("12x", None), ("3000000000", None), ("3000000000.5", None),
    (None, None), ("2147483647", 2147483647), ("-2147483648.9", -2147483648),
]


@pytest.mark.parametrize("text, expected", TEXT_INTS)
def test_text_to_int(spark, text, expected):
    df = spark.createDataFrame(
        [("2025-06-01", "A", "1", text, "2")],
        "date string, station_name string, total_delay_minutes string, train_count string, "
        "avg_delay_minutes string",
    )
    assert conform(df, DELAYS).first()["train_count"] == expected


@pytest.mark.parametrize(
    "kind, value, expected",
    [("double", 12.7, 12), ("double", -12.7, -12), ("double", 3e9, 2147483647),
     ("double", -3e9, -2147483648), ("double", float("nan"), 0), ("double", None, None),
     ("double", 2147483647.9, 2147483647), ("double", -2147483648.5, -2147483648),
     ("bigint", 7, 7), ("bigint", 2**32 + 5, 5), ("bigint", 2**31, -(2**31)),
     ("boolean", True, 1)],
)
def test_number_to_int(spark, kind, value, expected):
    df = spark.createDataFrame(
        [("2025-06-01", "A", 1.0, value, 2.0)],
        f"date string, station_name string, total_delay_minutes double, train_count {kind}, "
        "avg_delay_minutes double",
    )
    assert conform(df, DELAYS).first()["train_count"] == expected


@pytest.mark.parametrize(
    "text, expected",
    [("2025-06-01", "2025-06-01"), ("2025-6-1", "2025-06-01"), ("bad", None), ("", None),
     ("2025-02-30", None), (None, None)],
)
def test_text_to_date(spark, text, expected):
    df = spark.createDataFrame(
        [(text, "A", "x", "1", "2")],
        "date string, station_name string, total_delay_minutes string, train_count string, "
        "avg_delay_minutes string",
    )
    row = conform(df, DELAYS).first()
    assert (str(row["date"]) if row["date"] else None) == expected
    assert row["total_delay_minutes"] is None


def test_conform_is_idempotent_and_ordered(spark):
    df = spark.createDataFrame(
        [(1, "A", 2.5, "x", "2025-06-01")],
        "train_count int, station_name string, total_delay_minutes double, "
        "avg_delay_minutes string, date string",
    )
    once = conform(df, DELAYS)
    assert once.schema == DELAYS
    assert conform(once, DELAYS).collect() == once.collect()
    assert conform(once, DELAYS).schema == DELAYS


def test_missing_column_raises(spark):
    with pytest.raises(Exception):
        conform(spark.range(1), WEATHER)


NAMES = [
    ("2025-11-24_2025-11-30_delays.csv", "2025-11-24", "2025-11-30", True),
    ("2025-1-5_2025-1-11_delays.csv", "2025-1-5", "2025-1-11", True),
    ("2025-11-24_2025-11-30_extra_delays.csv", "2025-11-24", "2025-11-30", True),
    ("2025-11-30_2025-11-24_delays.csv", "2025-11-30", "2025-11-24", True),
    ("2025-02-30_2025-03-05_delays.csv", "2025-02-30", "2025-03-05", False),
    ("2025-11-24_delays.csv", "2025-11-24", None, False),
    ("25-11-24_2025-11-30_delays.csv", "25-11-24", "2025-11-30", False),
    ("0000-11-24_2025-11-30_delays.csv", "0000-11-24", "2025-11-30", False),
    ("2025-11-24_2025-11-30\n_delays.csv", "2025-11-24", "2025-11-30\n", False),
    ("_2025-11-30_delays.csv", "", "2025-11-30", False),
    ("", "", None, False),
]


@pytest.mark.parametrize("name, start, end, valid", NAMES)
def test_date_range(spark, name, start, end, valid):
    assert tuple(_value(spark, "string", name, date_range)) == (start, end, valid)


def _is_day(text):
    try:
        datetime.strptime(text, "%Y-%m-%d")
    except ValueError:
        return False
    return True


def test_random_names_against_strptime(spark):
    random.seed(5)
    pieces = ["2025", "1999", "0001", "25", "-", "-", "-", "_", "_", "1", "01", "12", "13", "2",
              "29", "30", "31", "00", "_delays.csv", " ", "x", "2025-06-01", "2024-2-29"]
    names = {"".join(random.choices(pieces, k=random.randint(1, 12))) for _ in range(4000)}
    names |= {
        f"{y}-{m}-{d}_{y}-0{m}-{d}_delays.csv"
        for y in (2024, 2025) for m in range(15) for d in range(33)
    }
    df = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    rows = df.select("name", date_range(F.col("name"))["valid"].alias("valid")).collect()
    found = set()
    for name, valid in rows:
        parts = name.replace("_delays.csv", "").split("_")
        assert valid == (len(parts) > 1 and _is_day(parts[0]) and _is_day(parts[1])), name
        found.add(valid)
    assert found == {True, False}


def test_last_segment(spark):
    assert _value(spark, "string", "s3://b/a/x.csv", last_segment) == "x.csv"
    assert _value(spark, "string", "x.csv", last_segment) == "x.csv"
    assert _value(spark, "string", "a/", last_segment) == ""


PIECES = ["", " ", "+", "-", ".", "0", "7", "12", "2147483647", "2147483648", "e", "E3", "1e400",
          "inf", "Infinity", "NaN", "nan", "d", "f", "x", "0x1p3", "\t", "\x7f", "\x1f", "é",
          "2025-06-01", "2025-6", "T10:00", "true", "١", "_"]


def test_casts_equal_the_casts_without_ansi(spark):
    """Text and numbers of every kind against Spark's own cast with ANSI mode off."""
    random.seed(3)
    texts = sorted({"".join(random.choices(PIECES, k=random.randint(0, 4))) for _ in range(4000)})
    numbers = [random.uniform(-5e9, 5e9) for _ in range(200)]
    numbers += [0.0, -0.0, 2147483647.0, 2147483647.5, -2147483648.9, 1e300, math.inf, -math.inf]
    longs = [random.randint(-(2**63), 2**63 - 1) for _ in range(200)] + [2**31, -(2**31) - 1, 5]
    inputs = [(texts, "string", ("int", "double", "date", "string")),
              (numbers, "double", ("int", "string", "double")),
              (numbers, "float", ("int", "double")),
              (longs, "bigint", ("int", "double", "string")),
              ([True, False, None], "boolean", ("int", "double", "string"))]
    for values, kind, targets in inputs:
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        source = df.schema["v"].dataType
        kinds = {t: df.select(F.col("v").cast(t)).schema[0].dataType for t in targets}
        # As text, since Python has no years beyond 9999.
        ours = df.select(
            "v", *[lenient_cast(F.col("v"), source, k).cast("string") for k in kinds.values()]
        )
        actual = [str(tuple(r)) for r in ours.collect()]
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            plain = df.select("v", *[F.col("v").cast(t).cast("string") for t in targets])
            expected = [str(tuple(r)) for r in plain.collect()]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
        assert actual == expected
