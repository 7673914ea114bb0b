"""Local days against Python's own zone rules."""

import random
from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from dayledger.functions.zones import day_hours, day_start, local_day, local_time
from dayledger.operators.local_days import complete_days, daily_values, with_local_day, with_zone

ZONES = [
    "UTC", "Europe/Budapest", "America/New_York", "Asia/Kathmandu", "Australia/Lord_Howe", "Pacific/Apia",
    "America/Havana", "America/Sao_Paulo", "Asia/Beirut", "Africa/Cairo", "Pacific/Kiritimati",
]


@pytest.fixture(params=["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def session_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def _instants(n=1500):
    random.seed(7)
    changes = [datetime(2024, 3, 10, 7), datetime(2024, 3, 31, 1), datetime(2024, 11, 3, 6), datetime(2011, 12, 30, 10),
               datetime(2018, 11, 4, 3), datetime(2024, 4, 6, 15), datetime(2024, 10, 26, 23)]
    out = []
    for i in range(n):
        base = random.choice(changes) if i % 2 else datetime(random.randint(1975, 2030), 1, 1)
        span = 90_000 if i % 2 else 366 * 86_400
        out.append(base + timedelta(seconds=random.randint(-span, span), microseconds=random.choice([0, 1, 999_999])))
    return out


def test_local_days_in_any_session_zone(spark, session_zone):
    rows = [(k, int(t.replace(tzinfo=UTC).timestamp()) * 1_000_000 + t.microsecond, random.choice(ZONES))
            for k, t in enumerate(_instants())]
    df = spark.createDataFrame(rows, "k int, micros long, zone string")
    df = df.withColumn("t", F.timestamp_micros("micros"))
    zone = F.col("zone")
    found = df.select("k", local_day(F.col("t"), zone).alias("day"), local_time(F.col("t"), zone).alias("s"))
    by_key = {r["k"]: (r["day"], r["s"]) for r in found.collect()}
    for k, micros, name in rows:
        there = datetime.fromtimestamp(micros // 1_000_000, UTC).astimezone(ZoneInfo(name))
        assert by_key[k] == (there.date(), there.hour * 3600 + there.minute * 60 + there.second)


def _first_second(day, zone):
    """By trial: the first minute whose local day this is."""
    t = datetime(day.year, day.month, day.day, tzinfo=UTC) - timedelta(hours=15)
    while t.astimezone(zone).date() < day:
        t += timedelta(minutes=15)
    return t


def test_where_a_day_begins_and_how_long_it_is(spark, session_zone):
    days = [date(2024, 3, 10), date(2024, 3, 31), date(2024, 11, 3), date(2018, 11, 4), date(2024, 4, 7), date(2024, 10, 27),
            date(2024, 6, 1), date(2018, 2, 17), date(2018, 2, 18)]
    rows = [(z, d) for z in ZONES for d in days]
    df = spark.createDataFrame(rows, "zone string, day date")
    found = df.select(
        "zone", "day", F.unix_seconds(day_start(F.col("day"), F.col("zone"))).alias("start"),
        day_hours(F.col("day"), F.col("zone")).alias("hours"),
    )
    for r in found.collect():
        zone = ZoneInfo(r["zone"])
        start, after = (_first_second(d, zone) for d in (r["day"], r["day"] + timedelta(days=1)))
        assert r["start"] == start.timestamp(), r
        assert r["hours"] == (after - start).total_seconds() / 3600, r


def test_nulls_and_unknown_zones(spark):
    df = spark.createDataFrame([(0, None), (None, "UTC")], "s long, zone string")
    found = with_local_day(df.withColumn("t", F.timestamp_seconds("s")), "t")
    assert [r["date"] for r in found.collect()] == [None, None]
    bad = spark.createDataFrame([(0, "Nowhere/At_All")], "s long, zone string")
    with pytest.raises(Exception):
        with_local_day(bad.withColumn("t", F.timestamp_seconds("s")), "t").collect()
    assert len(with_local_day(bad.limit(0).withColumn("t", F.timestamp_seconds("s")), "t").collect()) == 0


def test_daily_values_across_clock_changes(spark):
    """An observation every hour for three weeks around the change, in three zones, by hand."""
    zones = {"A": "Europe/Budapest", "B": "America/New_York", "C": "Asia/Kathmandu", None: "UTC"}
    first = datetime(2024, 3, 5, tzinfo=UTC)
    rows = [(s, int((first + timedelta(hours=h)).timestamp()), float(h % 31), float(h % 7) if h % 5 else None)
            for s in [*zones, "no zone"] for h in range(24 * 30)]
    df = spark.createDataFrame(rows, "station_name string, s long, temperature double, rain double")
    stations = spark.createDataFrame(list(zones.items()), "station_name string, zone string")
    zoned = with_zone(df, stations, ["station_name"], missing="Etc/GMT+12")
    daily = daily_values(zoned.withColumn("t", F.timestamp_seconds("s")), ["station_name"], "t",
                         kinds={"temperature": "mean", "rain": "sum"})
    expected = {}
    for s, t, temperature, rain in rows:
        zone = ZoneInfo(zones.get(s, "Etc/GMT+12"))
        day = datetime.fromtimestamp(t, UTC).astimezone(zone).date()
        expected.setdefault((s, day), []).append((temperature, rain))
    found = {(r["station_name"], r["date"]): r for r in daily.collect()}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        r = found[key]
        assert r["observations"] == len(values)
        assert r["temperature"] == pytest.approx(sum(v for v, _ in values) / len(values))
        assert r["rain"] == sum(v for _, v in values if v is not None)
    assert found["A", date(2024, 3, 31)]["hours"] == 23 == found["B", date(2024, 3, 10)]["hours"]
    whole = {(r["station_name"], r["date"]) for r in complete_days(daily).collect()}
    assert ("A", date(2024, 3, 31)) in whole and ("A", date(2024, 3, 5)) not in whole
    assert {len(expected[k]) for k in whole} == {23, 24}


def test_an_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError, match="median"):
        daily_values(spark.range(1), ["id"], "id", kinds={"id": "median"})
