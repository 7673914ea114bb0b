"""Layouts that let scans skip files, sketches that add up, and lines that are turned away."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dayledger.functions.zorder import with_z_key, z_key
from dayledger.operators.report import load_report, load_sketch, merged_report
from dayledger.plans.landing import initial_load
from dayledger.sinks.folders import PARQUET_OPTIONS, write_folder
from dayledger.sinks.publish import publish_bucketed
from dayledger.sources.responses import accepted_lines, checked_lines, rejected_lines


def _grid(spark, hot, n=40_000):
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.rand(1) * 365).cast("int"))
    station = F.when(F.rand(2) < hot, 7).otherwise((F.rand(3) * 300).cast("int"))
    return spark.range(n).select(
        day.alias("date"), F.concat(F.lit("Station "), F.lpad(station.cast("string"), 4, "0")).alias("station_name"),
        F.col("id").alias("value"),
    )


def _files_touched(spark, folder, column, value):
    files = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    return files.where((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))).count(), files.count()


@pytest.mark.parametrize("hot, share", [(0.0, 0.25), (0.33, 0.45)])
def test_filters_on_either_column_skip_most_files(spark, tmp_path, hot, share):
    """Also where a third of all rows is one station's."""
    rows = _grid(spark, hot)
    folder = str(tmp_path / "z")
    assert write_folder(rows, folder, "parquet", 128, z_order=("date", "station_name"), **PARQUET_OPTIONS) == 40_000
    for column, values in (("date", [date(2025, 1, 1), date(2025, 5, 5), date(2025, 12, 30)]),
                           ("station_name", ["Station 0001", "Station 0150", "Station 0299"])):
        for value in values:
            touched, files = _files_touched(spark, folder, column, value)
            assert files == 128 and touched < files * share, (column, value, touched)
    assert spark.read.parquet(folder).exceptAll(rows).isEmpty()
    # The order by one column alone leaves the other one in all files.
    write_folder(rows, str(tmp_path / "one"), "parquet", 64, cluster_by=("date",))
    touched, files = _files_touched(spark, str(tmp_path / "one"), "station_name", "Station 0150")
    assert touched > files / 2


def test_z_key_of_nulls_and_odd_columns(spark):
    rows = [(None, None, None), (1.5, "", date(2025, 1, 1)), (None, "é", None), (-3.0, "a" * 50, date(1, 1, 1))]
    df = spark.createDataFrame(rows, "x double, s string, d date")
    keys = [r["z"] for r in df.select(z_key(df, ("x", "s", "d")).alias("z")).collect()]
    assert len(keys) == 4 and all(k >= 0 for k in keys) and keys[0] == 0
    assert df.limit(0).select(z_key(df.limit(0), ("x", "s")).alias("z")).collect() == []
    with pytest.raises(ValueError, match="no order"):
        z_key(df.withColumn("m", F.array("x")), ("m",))
    with pytest.raises(ValueError, match="cluster_by or by z_order"):
        write_folder(df, "/nowhere", "parquet", cluster_by=("x",), z_order=("s",))


def test_halving_gives_the_key_of_comparing_with_all_bounds(spark):
    """Also of nulls, NaN, infinities, values equal to a bound, and columns with a single value or none."""
    random.seed(3)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = [
        (random.choice([*odd, random.random(), float(random.randrange(5))]), random.choice([None, "", "é", f"Station {random.randrange(999):03}"]),
         random.choice([None, date(2024, 1, 1) + timedelta(random.randrange(400))]), 7, None)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "x double, s string, d date, one int, nothing long")
    for columns in (("x", "s"), ("d", "s", "x"), ("one",), ("nothing", "one", "d")):
        keyed = with_z_key(df, columns).withColumn("whole", z_key(df, columns))
        assert keyed.columns == [*df.columns, "_z", "whole"]
        assert keyed.where(~F.col("_z").eqNullSafe(F.col("whole"))).isEmpty() and keyed.select("_z").distinct().count() >= 1
    # No higher-order function, which would be interpreted row by row.
    plan = with_z_key(df, ("x", "s"))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan


def test_near_in_both_columns_is_near_in_the_key(spark):
    df = spark.range(64 * 64).select((F.col("id") % 64).alias("a"), F.expr("id div 64").alias("b"))
    rows = df.select("a", "b", z_key(df, ("a", "b")).alias("z")).orderBy("z").collect()
    # Any quarter of the order lies in a quarter of the square.
    quarter = rows[: len(rows) // 4]
    assert max(r["a"] for r in quarter) < 34 and max(r["b"] for r in quarter) < 34


# ---------------------------------------------------------------- sketches

FLAGS = ("extreme_temperature", "extreme_wind", "extreme_precipitation")


def _rows(spark, first, last, days):
    flags = [(F.col("id") % k == 0).cast("int").alias(f) for k, f in zip((3, 5, 7), FLAGS, strict=True)]
    return spark.range(first, last).select(
        F.concat(F.lit("S"), F.expr("id % 40000")).alias("station_name"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % days).cast("int")).cast("string").alias("date"), *flags,
    )


def test_sketches_of_two_loads_add_up(spark):
    one, two = _rows(spark, 0, 30_000, 700), _rows(spark, 20_000, 60_000, 1500)
    sketches = load_sketch(one).union(load_sketch(two))
    both = one.union(two)
    exact = load_report(both).first().asDict()
    near = merged_report(sketches).first().asDict()
    assert near.keys() == exact.keys()
    for name, value in exact.items():
        if name.startswith("unique"):
            assert abs(near[name] - value) <= 0.02 * value
        else:
            assert near[name] == value
    assert merged_report(sketches, exact=both).first().asDict() == exact
    assert merged_report(sketches.limit(0)).first()["total_records"] == 0


def _inputs(tmp_path, lines):
    registry = tmp_path / "stations.json"
    registry.write_text("\n".join(json.dumps({"station_name": f"S{i}", "lat": 1, "lon": 2}) for i in range(30)))
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.json").write_text("\n".join(lines))
    return {"registry": str(registry), "responses": str(tmp_path / "r"), "registry_lines": True}


def _good(i, days=5):
    time = [(date(2025, 6, 1) + timedelta(days=d)).isoformat() for d in range(days)]
    body = {"daily": {"time": time, "temperature_2m_mean": [40.0] * days, "wind_gusts_10m_max": [1.0] * days,
                      "precipitation_sum": [1.0] * days}}
    return json.dumps({"position": i, "station_name": f"S{i}", "status": 200, "body": json.dumps(body)})


def test_each_load_stores_its_sketch(spark, tmp_path):
    inputs = _inputs(tmp_path, [_good(i) for i in range(30)])
    for k, (start, end) in enumerate((("2025-06-01", "2025-06-03"), ("2025-06-03", "2025-06-05"))):
        initial_load(spark, **inputs, output=str(tmp_path / f"out{k}"), start=start, end=end, sketches=str(tmp_path / "sketches"))
    report = merged_report(spark.read.parquet(str(tmp_path / "sketches"))).first().asDict()
    assert report == {"total_records": 180, "unique_dates": 5, "unique_stations": 30, "extreme_temp_count": 180,
                      "extreme_wind_count": 0, "extreme_precip_count": 0}


# ---------------------------------------------------------------- rejects

BAD = {
    "not JSON": ["{", "no json", '{"position": 1, "status": 200', "'position'"],
    "not an object": ["[1]", "17", '"text"', "null"],
    "a field of another type": ['{"position": "x", "status": 200}', '{"position": 1, "status": {"a": 1}}'],
    "no key": ["{}", '{"status": 200, "body": "x"}', '{"position": null, "status": 1}'],
    "no status and no body": ['{"position": 3}'],
}


def test_rows_in_are_rows_used_and_rows_rejected(spark, tmp_path):
    good = [_good(i) for i in range(20)] + ['{"position": 25, "status": 503}', '{"position": 26, "body": null, "status": 200, "more": 1}']
    bad = [line for lines in BAD.values() for line in lines]
    lines = good + bad + ["", "   "]
    random.Random(8).shuffle(lines)
    inputs = _inputs(tmp_path, lines)
    checked = checked_lines(spark, inputs["responses"])
    found = {}
    for r in rejected_lines(checked).collect():
        found.setdefault(r["reason"], []).append(r["line"])
        assert r["file"].endswith("/a.json")
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in BAD.items()}
    assert accepted_lines(checked).count() == len(good)
    assert checked.count() == len(good) + len(bad)
    report = initial_load(spark, **inputs, output=str(tmp_path / "out"), rejected=str(tmp_path / "bad"))
    assert (report["successful"], report["failed"], report["rejected"]) == (20, 10, len(bad))
    assert sorted(r["line"] for r in spark.read.json(str(tmp_path / "bad")).collect()) == sorted(bad)
    plain = initial_load(spark, **inputs, output=str(tmp_path / "plain"))
    assert plain == {k: v for k, v in report.items() if k != "rejected"}
    with pytest.raises(ValueError, match="lines of JSON"):
        initial_load(spark, **inputs, output="x", responses_format="parquet", rejected="y")


# ---------------------------------------------------------------- buckets


def test_tables_in_buckets_are_joined_without_a_shuffle(spark, tmp_path):
    names = "b_stations", "b_rows"
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    stations = spark.range(100).select(F.col("id").alias("position"), F.concat(F.lit("S"), "id").alias("name"))
    rows = spark.range(5000).select((F.col("id") % 120).alias("position"), F.col("id").alias("value"))
    rows = rows.union(spark.createDataFrame([(None, -1)], "position long, value long"))
    assert publish_bucketed(stations, names[0], str(tmp_path), ("position",), 6) == 100
    for part in (rows.where("value < 100"), rows):
        assert publish_bucketed(part, names[1], str(tmp_path), ("position",), 6) == part.count()
        joined = spark.table(names[1]).join(spark.table(names[0]).hint("merge"), "position")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        grouped = spark.table(names[1]).groupBy("position").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        expected = part.join(stations, "position")
        assert joined.exceptAll(expected).isEmpty() and joined.count() == expected.count()
    files = spark.table(names[1]).select("_metadata.file_name").distinct().count()
    assert files <= 6
    # Another number of buckets: the table is defined anew.
    publish_bucketed(rows, names[1], str(tmp_path), ("position",), 3)
    assert spark.table(names[1]).count() == 5001
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("b_rows")]
    assert left == ["b_rows"]
    with pytest.raises(ValueError, match="a key and a number"):
        publish_bucketed(rows, names[1], str(tmp_path), (), 3)
    for name in names:
        spark.sql(f"DROP TABLE {name}")
