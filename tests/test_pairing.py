"""One response per station, chosen by small keys."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dayledger.operators.pairing import pair
from dayledger.sources.responses import read_responses

STATIONS = "position int, station_name string, lat double, lon double"


def _stations(spark, n=30):
    return spark.createDataFrame([(i, f"S{i % 7}", 1.0, 2.0) for i in range(n)], STATIONS)


def _by_hand(lines):
    best = {}
    for position, status, body in lines:
        body = None if status >= 400 else body
        best.setdefault(position, []).append(body)
    return {p: max(bodies, key=lambda b: (b is not None, len((b or "").encode()))) for p, bodies in best.items()}


def _write(folder, lines, files):
    for k in range(files):
        (folder / f"{k}.json").write_text("\n".join(
            json.dumps({"position": p, "station_name": "x", "status": s, "body": b}) for p, s, b in lines[k::files]
        ))


@pytest.mark.parametrize("files", [1, 5])
def test_one_response_per_station(spark, tmp_path, files):
    random.seed(5)
    lines = [(random.choice([3, 3, 3, *range(28)]), random.choice([200, 200, 503]), "é" * random.randint(0, 4) + "b" * random.randint(0, 9))
             for _ in range(600)]
    lines += [(29, 503, "x"), (29, 404, "y"), (100, 200, "no station")]
    _write(tmp_path, lines, files)
    found = pair(_stations(spark), read_responses(spark, str(tmp_path))).collect()
    expected = {p: b for p, b in _by_hand(lines).items() if p < 30}
    assert sorted(r["position"] for r in found) == sorted(expected)
    for r in found:
        body = expected[r["position"]]
        assert (r["body"] is None) == (body is None)
        assert body is None or len(r["body"].encode()) == len(body.encode())
        assert r["station_name"] == f"S{r['position'] % 7}"


def test_of_equally_long_bodies_always_the_same_stays(spark, tmp_path):
    lines = [(1, 200, f"body {k:03d}") for k in range(50)] * 2
    seen = set()
    for k, files in enumerate((1, 3, 7)):
        folder = tmp_path / str(k)
        folder.mkdir()
        random.Random(k).shuffle(lines)
        _write(folder, lines, files)
        (row,) = pair(_stations(spark), read_responses(spark, str(folder))).collect()
        seen.add(row["body"])
    assert len(seen) == 1


def test_rows_of_a_frame_without_files(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (2, None), (None, "z"), (None, "zz"), (3, "b")]
    responses = spark.createDataFrame(rows, "position int, body string")
    stations = _stations(spark, 5).unionByName(
        spark.createDataFrame([(None, "N", 0.0, 0.0)], STATIONS)
    )
    found = pair(stations, responses)
    assert found.columns[:2] == ["position", "body"]
    assert sorted(map(str, ((r["position"], r["body"]) for r in found.collect()))) == sorted(
        map(str, [(1, "a"), (2, None), (None, "zz"), (3, "b")])
    )
    assert pair(stations, responses.limit(0)).collect() == []


def test_stations_that_share_a_name_share_its_response(spark):
    responses = spark.createDataFrame([("S1", "a"), ("S1", "abc"), ("S2", "x"), ("S2", "x")], "station_name string, body string")
    found = pair(_stations(spark, 14), responses, ("station_name",)).collect()
    assert sorted((r["position"], r["body"]) for r in found) == [(1, "abc"), (2, "x"), (8, "abc"), (9, "x")]


def test_bodies_are_in_no_sort_and_a_hot_position_is_dealt_out(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = [(3 if k % 3 == 0 else k % 30, 200, f"{{{k}}}" * (k % 40)) for k in range(3000)]
        _write(tmp_path, lines, 4)
        paired = pair(_stations(spark), read_responses(spark, str(tmp_path)))
        plan = paired._jdf.queryExecution().executedPlan().toString()
        initial = plan.split("Initial Plan")[-1]
        assert "ShuffledHashJoin" in initial and "SortAggregate" not in initial
        for line in initial.splitlines():
            assert "Sort [" not in line or "body" not in line
        # Different responses of one position go to different partitions.
        ranked = spark.read.json(str(tmp_path)).where("position = 3")
        keys = ranked.select(F.xxhash64("body").alias("rank"), "position").repartition(8, "position", "rank")
        assert keys.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
