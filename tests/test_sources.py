"""Registry, responses, folder listing and arrivals."""

import json
import os

import pytest
from pyspark.sql import functions as F

from dayledger.operators.arrivals import ArrivalError, newest, newest_range, with_date_range
from dayledger.sources.registry import batch_sizes, in_batch, read_registry, with_batch
from dayledger.sources.responses import read_responses
from dayledger.sources.tables import days_between, files_fingerprint, list_folder


def _registry(spark, folder, entries):
    path = folder / "stations.json"
    path.write_text(json.dumps(entries, indent=1, ensure_ascii=False), encoding="utf-8")
    return read_registry(spark, str(path))


def test_registry_keeps_order_and_converts_coordinates(spark, tmp_path):
    entries = [
        {"station_name": "Győr", "lat": 47.68, "lon": "17.63", "more": [1]},
        {"station_name": 'A, "B"', "lat": "47.1", "lon": 19},
        {"station_name": None, "lat": "x", "lon": None},
    ]
    rows = _registry(spark, tmp_path, entries).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [
        (0, "Győr", 47.68, 17.63),
        (1, 'A, "B"', 47.1, 19.0),
        (2, None, None, None),
    ]


@pytest.mark.parametrize("key", ["station_name", "lat", "lon"])
def test_missing_key_is_fatal_within_the_batch_only(spark, tmp_path, key):
    entries = [{"station_name": f"S{i}", "lat": 1, "lon": 2} for i in range(3)]
    del entries[2][key]
    stations = _registry(spark, tmp_path, entries)
    assert in_batch(stations, 0, size=2).count() == 2
    assert len(in_batch(stations, 0, size=2).collect()) == 2
    with pytest.raises(Exception, match="registry entry without"):
        stations.collect()


@pytest.mark.parametrize("text", ["[{", " ", "null", '{"station_name": "A"}'])
def test_registry_that_is_no_array_is_fatal(spark, tmp_path, text):
    (tmp_path / "stations.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|empty registry document"):
        read_registry(spark, str(tmp_path / "stations.json")).collect()


@pytest.mark.parametrize(
    "n, sizes",
    [(0, (0, 0, 0)), (900, (900, 0, 0)), (901, (900, 1, 0)), (1800, (900, 900, 0)),
     (1801, (900, 900, 1)), (2701, (900, 900, 901))],
)
def test_batches(spark, n, sizes):
    stations = spark.range(n).withColumnRenamed("id", "position")
    assert tuple(batch_sizes(stations).first()) == (n, *sizes)
    assert tuple(in_batch(stations, b).count() for b in range(3)) == sizes
    numbered = {r["batch"]: r["count"] for r in with_batch(stations).groupBy("batch").count().collect()}
    assert numbered == {b: size for b, size in enumerate(sizes) if size}


def test_no_such_batch(spark):
    with pytest.raises(ValueError):
        in_batch(spark.range(1).withColumnRenamed("id", "position"), 3)


def test_failed_requests_have_no_body(spark, tmp_path):
    lines = [
        {"station_name": "A", "status": 200, "body": "{}"},
        {"station_name": "B", "status": 404, "body": "{}"},
        {"station_name": "C", "status": 500, "body": "{}"},
        {"station_name": "D", "body": "{}"},
        {"station_name": "E", "status": 302, "body": "{}"},
    ]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(line) for line in lines))
    rows = read_responses(spark, str(tmp_path), on=("station_name",)).collect()
    assert {r["station_name"]: r["body"] for r in rows} == {
        "A": "{}", "B": None, "C": None, "D": "{}", "E": "{}"}


def _touch(path, when, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (when, when))


def test_listing_has_direct_children_only_and_reads_no_content(spark, tmp_path):
    _touch(tmp_path / "2025-01-01_2025-01-07_delays.csv", 1000)
    _touch(tmp_path / str(tmp_path)[1:] / "2026-01-01_2026-01-07_delays.csv", 3000)
    _touch(tmp_path / "deeper" / "2026-01-01_2026-01-07_delays.csv", 3000)
    _touch(tmp_path / "year=2026" / "2026-01-01_2026-01-07_delays.csv", 3000)
    for folder in (f"{tmp_path}", f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}"):
        listing = list_folder(spark, folder)
        assert [r["name"] for r in listing.collect()] == ["2025-01-01_2025-01-07_delays.csv"]
    with pytest.raises(ValueError):
        list_folder(spark, "arrivals")
    (tmp_path / "_hidden").write_text("x")
    assert listing.count() == list_folder(spark, str(tmp_path)).count() == 1


def test_newest_file(spark, tmp_path):
    _touch(tmp_path / "2025-11-24_2025-11-30_delays.csv", 2000)
    _touch(tmp_path / "2025-12-01_2025-12-07_delays.csv", 1000)
    assert newest_range(list_folder(spark, str(tmp_path))) == ("2025-11-24", "2025-11-30")
    _touch(tmp_path / "2025-11-17_2025-11-23_delays.csv", 2000)
    assert newest_range(list_folder(spark, str(tmp_path))) == ("2025-11-17", "2025-11-23")
    _touch(tmp_path / "notes.txt", 3000)
    with pytest.raises(ArrivalError, match="notes.txt"):
        newest_range(list_folder(spark, str(tmp_path)))


def test_no_file_has_arrived(spark, tmp_path):
    with pytest.raises(ArrivalError, match="no file"):
        newest_range(list_folder(spark, str(tmp_path)))


def test_newest_is_a_top_one(spark):
    manifest = spark.range(100).select(
        F.timestamp_seconds(F.col("id") % 10).alias("modificationTime"),
        F.col("id").cast("string").alias("path"),
    )
    top = newest(manifest)
    assert top.first()["path"] == "19"
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_changes_with_the_files(spark, tmp_path):
    folder = tmp_path / "t"
    _touch(folder / "a.csv", 1000, "1,x\n")
    spark.sql(f"CREATE TABLE f_table (n INT, Location STRING) USING csv LOCATION '{folder}'")
    first = files_fingerprint(spark, "f_table")
    assert first is not None and first == files_fingerprint(spark, "f_table")
    _touch(folder / "b.csv", 1000, "2,y\n")
    second = files_fingerprint(spark, "f_table")
    _touch(folder / "b.csv", 2000, "2,z\n")
    assert len({first, second, files_fingerprint(spark, "f_table")}) == 3
    spark.sql("CREATE OR REPLACE TEMP VIEW f_view AS SELECT * FROM f_table")
    assert files_fingerprint(spark, "f_view") is None
    spark.sql(f"CREATE TABLE f_parts (n INT, p INT) USING csv PARTITIONED BY (p) "
              f"LOCATION '{tmp_path / 'p'}'")  # fmt: skip
    assert files_fingerprint(spark, "f_parts") is None


def test_range_columns(spark):
    manifest = spark.createDataFrame([("2025-1-5_2025-1-11_delays.csv",)], "name string")
    assert tuple(with_date_range(manifest).first()) == (
        "2025-1-5_2025-1-11_delays.csv", "2025-1-5", "2025-1-11", True)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_days_between_is_inclusive(spark, kind):
    times = ["2025-05-31 23:59:59", "2025-06-01 00:00:00", "2025-06-02 23:59:59", "2025-06-03 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind))
    assert days_between(df, "t", "2025-06-01", "2025-06-02").count() == 2
