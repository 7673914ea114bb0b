"""Valid prefix, flags and status per station, on hand-made bodies."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dayledger.operators.prefix import valid_prefix_rows
from dayledger.operators.report import load_status, station_status
from dayledger.plans.landing import checked_series, weather_rows
from dayledger.schemas import RAW_WEATHER, Thresholds

D1, D2, D3 = "2025-06-01", "2025-06-02", "2025-06-03"
NAN = float("nan")


def body(time, t, w, p, **more):
    series = {"time": time, "temperature_2m_mean": t, "wind_gusts_10m_max": w}
    return json.dumps({"daily": {**series, "precipitation_sum": p}, **more})


# body, days kept, status
CASES = {
    "good": (body([D1, D2], [1, 36], [1, 61], [0, 21]), [D1, D2], "ok"),
    "null in middle": (body([D1, D2, D3], [1, None, 3], [1, 61, 1], [0, 21, 1]), [D1], "error"),
    "null first": (body([D1], [None], [1], [1]), [], "error"),
    "short measure": (body([D1, D2, D3], [1, 2], [1, 1, 1], [1, 1, 1]), [D1, D2], "error"),
    "long measure": (body([D1], [1, 2], [1, 2, 3], [1, 2, 3]), [D1], "ok"),
    "missing series": ('{"daily": {"time": ["2025-06-01"], "temperature_2m_mean": [1]}}', [], "error"),
    "missing series, no days": ('{"daily": {"time": [], "temperature_2m_mean": []}}', [], "error"),
    "null series": (body([D1], None, [1], [1]), [], "error"),
    "null series, no days": (body([], None, [], []), [], "ok"),
    "series is a number": (body([D1], 5, [1], [1]), [], "error"),
    "no daily": ('{"hourly": {}}', [], "error"),
    "null daily": ('{"daily": null}', [], "error"),
    "null time": (body(None, [1], [1], [1]), [], "error"),
    "empty": (body([], [], [], []), [], "ok"),
    "null date": (body([None, D2], [1, 2], [1, 1], [1, 1]), [None, D2], "ok"),
    "NaN": (body([D1], [NAN], [1], [1]), [D1], "ok"),
    "infinite": (body([D1], [float("inf")], [1], [1]), [D1], "ok"),
    "text in series": (body([D1, D2], [1, "2"], [1, 1], [1, 1]), [D1], "error"),
    "NaN as text": (body([D1, D2], [1, "NaN"], [1, 1], [1, 1]), [D1], "error"),
    "Infinity as text": (body([D1, D2], [1, "-Infinity"], [1, 1], [1, 1]), [D1], "error"),
    "negative infinity": (body([D1], [float("-inf")], [1], [1]), [D1], "ok"),
    "object in series": (body([D1, D2], [1, {"a": 1}], [1, 1], [1, 1]), [D1], "error"),
    "true in series": (body([D1, D2], [1, True], [1, 1], [1, 1]), [D1, D2], "ok"),
    "more fields": (body([D1], [1], [1], [1], latitude=1.5, error=False), [D1], "ok"),
    "not JSON": ("<html>", [], "error"),
    "cut off": (body([D1], [1], [1], [1])[:-3], [], "error"),
    "brace missing": (body([D1], [1], [1], [1])[:-1], [], "error"),
    "braces missing": (body([D1], [1], [1], [1])[:-2], [], "error"),
    "NaN and text": (body([D1, D2], [NAN, 1], [1, "2"], [1, 1]), [D1], "error"),
    "NaN and gap": (body([D1, D2], [1, NAN], [1, 1], [1, None]), [D1], "error"),
    "empty body": ("", [], "error"),
    "no body": (None, [], "error"),
    "an array": ("[" + body([D1], [1], [1], [1]) + "]", [], "error"),
    "single quotes": (body([D1], [1], [1], [1]).replace('"', "'"), [], "error"),
}


@pytest.fixture(scope="module")
def checked(spark):
    stations = spark.createDataFrame(
        [(i, name, 47.4979133, 19.0402) for i, name in enumerate([*CASES, "no response"])],
        "position int, station_name string, lat double, lon double",
    )
    responses = spark.createDataFrame(
        [(name, case[0]) for name, case in CASES.items()], "station_name string, body string"
    )
    return stations, checked_series(stations, responses, on=("station_name",))


def test_prefix_and_status(checked):
    stations, series = checked
    status = {r["station_name"]: r["status"] for r in series.collect()}
    assert status == {name: case[2] for name, case in CASES.items()}
    days = {name: [] for name in CASES}
    for row in weather_rows(series).select("station_name", "date").collect():
        days[row["station_name"]].append(row["date"])
    assert days == {name: case[1] for name, case in CASES.items()}


def test_status_counts_stations_without_response(checked):
    stations, series = checked
    ok = sum(case[2] == "ok" for case in CASES.values())
    row = load_status(station_status(stations, series, ("station_name",))).first()
    assert (row["successful"], row["failed"]) == (ok, len(CASES) - ok + 1)


def test_rows_have_raw_schema_and_flags(checked):
    rows = weather_rows(checked[1])
    assert rows.schema.simpleString() == RAW_WEATHER.simpleString()
    good = rows.where("station_name = 'good'").orderBy("date").collect()
    flags = ["extreme_temperature", "extreme_wind", "extreme_precipitation"]
    assert [[r[f] for f in flags] for r in good] == [[0, 0, 0], [1, 1, 1]]
    nan = rows.where("station_name = 'NaN'").first()
    assert nan["extreme_temperature"] == 0


def _load(spark, stations, responses, **options):
    s = spark.createDataFrame(stations, "station_name string, lat double, lon double")
    r = spark.createDataFrame(responses, "station_name string, body string")
    range_ = {k: options[k] for k in ("start", "end") if k in options}
    series = checked_series(s, r, on=("station_name",), **options)
    return series, weather_rows(series, **range_)


def test_flag_before_narrowing(spark):
    _, rows = _load(spark, [("A", 1.0, 2.0)], [("A", body([D1], [35.0000001], [1], [1]))])
    row = rows.first()
    assert (row["temperature_mean_c"], row["extreme_temperature"]) == (35.0, 1)


def test_bad_coordinates_fail_the_station(spark):
    series, rows = _load(
        spark,
        [("A", None, 2.0), ("B", 1.0, 2.0), ("C", None, None)],
        [("A", body([D1], [1], [1], [1])), ("B", body([D1], [1], [1], [1])),
         ("C", body([], [], [], []))],
    )
    status = {r["station_name"]: r["status"] for r in series.collect()}
    assert status == {"A": "error", "B": "ok", "C": "ok"}
    assert [r["station_name"] for r in rows.collect()] == ["B"]


def test_null_station_name_is_kept(spark):
    _, rows = _load(spark, [(None, 1.0, 2.0)], [(None, body([D1], [1], [1], [1]))])
    assert [r["station_name"] for r in rows.collect()] == [None]


@pytest.mark.parametrize(
    "start, end, days, status",
    [(D2, D3, [D2, D3], "ok"), (D1, D1, [], "error"), (D2, D2, [D2], "ok"),
     ("2025-6-2", "2025-6-3", [D2, D3], "ok"), (D3, D2, [], "ok")],
)
def test_date_range_comes_before_the_prefix(spark, start, end, days, status):
    series, rows = _load(
        spark,
        [("A", 1.0, 2.0)],
        [("A", body([D1, D2, D3], [None, 2, 3], [1, 1, 1], [1, 1, 1]))],
        start=start,
        end=end,
    )
    assert series.first()["status"] == status
    assert sorted(r["date"] for r in rows.collect()) == days


def _by_hand(document, thresholds):
    """Day by day, as the rules say it."""
    daily = document["daily"]
    rows = []
    for i, day in enumerate(daily["time"]):
        values = []
        for name in ("temperature_2m_mean", "wind_gusts_10m_max", "precipitation_sum"):
            series = daily[name]
            if i >= len(series) or not isinstance(series[i], (int, float)):
                return rows, "error"
            values.append(series[i])
        t, w, p = values
        rows.append((
            day,
            int(t < thresholds.temperature_low or t > thresholds.temperature_high),
            int(w > thresholds.wind_high),
            int(p > thresholds.precipitation_high),
        ))
    return rows, "ok"


def test_random_bodies_against_brute_force(spark):
    random.seed(7)
    strange = [None, NAN, "NaN", float("-inf"), "5", True, [], -15, 35, 60, 20, -15.0, 35.0, 1e9, -0.0]

    def series(n):
        odd = random.random() < 0.4
        return [
            random.choice(strange)
            if odd and random.random() < 0.1
            else round(random.uniform(-40, 80), random.choice([0, 1, 9]))
            for _ in range(max(0, n + random.choice([0, 0, 0, 0, -1, 2])))
        ]

    documents = {}
    for i in range(300):
        n = random.randint(0, 12)
        daily = {"time": [f"2025-06-{d + 1:02d}" for d in range(n)]}
        for name in ("temperature_2m_mean", "wind_gusts_10m_max", "precipitation_sum"):
            daily[name] = series(n)
        documents[f"S{i}"] = {"daily": daily}
    checked, rows = _load(
        spark,
        [(name, 1.0, 2.0) for name in documents],
        [(name, json.dumps(document)) for name, document in documents.items()],
    )
    expected = {name: _by_hand(document, Thresholds()) for name, document in documents.items()}
    status = {r["station_name"]: r["status"] for r in checked.collect()}
    assert status == {name: case[1] for name, case in expected.items()}
    assert {"ok", "error"} == set(status.values())
    actual = {name: [] for name in documents}
    for r in rows.orderBy("date").collect():
        actual[r["station_name"]].append(
            (r["date"], r["extreme_temperature"], r["extreme_wind"], r["extreme_precipitation"])
        )
    assert actual == {name: case[0] for name, case in expected.items()}


def test_same_rows_from_a_stream(spark, tmp_path, checked):
    """The steps from body to rows need no state, so they run on a stream as they are."""
    responses = spark.createDataFrame(
        [(name, case[0], 1.0, 2.0) for name, case in CASES.items()],
        "station_name string, body string, lat double, lon double",
    )
    responses.write.parquet(str(tmp_path / "in"))
    from dayledger.operators.series import parse_daily, valid_prefix
    from dayledger.plans.landing import MEASURES

    def rows(df):
        return weather_rows(valid_prefix(parse_daily(df), MEASURES, ("lat", "lon")))

    stream = spark.readStream.schema(responses.schema).parquet(str(tmp_path / "in"))
    query = (
        rows(stream).writeStream.format("memory").queryName("streamed")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert spark.table("streamed").exceptAll(rows(responses)).isEmpty()
    assert spark.table("streamed").count() == rows(responses).count() > 0


def test_prefix_of_rows_with_a_hot_key(spark):
    """A third of the rows, many of them copies, belong to one key; keys may be NULL."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 100))
        .alias("key"),
        (F.col("id") % 700).alias("pos"),
        (F.xxhash64("id") % 97 == 0).alias("bad"),
    )
    kept = valid_prefix_rows(rows, ["key"], "pos", F.col("bad"))
    data = [tuple(r) for r in rows.collect()]
    first = {}
    for key, pos, bad in data:
        if bad:
            first[key] = min(pos, first.get(key, pos))
    expected = sorted((r for r in data if r[0] not in first or r[1] < first[r[0]]), key=str)
    assert "hot" in first
    assert sorted((tuple(r) for r in kept.collect()), key=str) == expected


def test_a_bad_row_without_position_takes_its_key_along(spark):
    rows = spark.createDataFrame(
        [("a", None, True), ("a", 1, False), ("b", None, False), ("b", 1, False), ("b", 2, True),
         ("c", None, False), ("c", 5, False)],
        "key string, pos int, bad boolean",
    )
    kept = valid_prefix_rows(rows, ["key"], "pos", F.col("bad"))
    expected = {("b", None), ("b", 1), ("c", None), ("c", 5)}
    assert {(r["key"], r["pos"]) for r in kept.collect()} == expected
