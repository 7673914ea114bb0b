"""Places without a window over all rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dayledger.operators.numbering import numbered, numbered_lines, with_starts
from dayledger.sources.registry import read_registry


@pytest.fixture
def small_pieces(spark):
    """Files are read in pieces of a few hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_numbered_is_the_order(spark):
    random.seed(3)
    # One value holds a third of the rows.
    values = [None if k % 50 == 0 else 7 if k % 3 == 0 else random.randint(0, 1000) for k in range(5000)]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v int, k int").repartition(6)
    found = sorted(numbered(df, ["v"]).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(5000))
    assert [r["v"] for r in found] == sorted(values, key=lambda v: (v is not None, v))
    assert sorted(r["k"] for r in found) == list(range(5000))
    down = sorted(numbered(df, [F.col("v").desc(), "k"], "place").collect(), key=lambda r: r["place"])
    assert [(r["v"], r["k"]) for r in down[:3]] == sorted(((v, k) for k, v in enumerate(values) if v is not None), key=lambda r: (-r[0], r[1]))[:3]


def test_equal_rows_are_numbered_by_several_tasks(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit("same").alias("v"))
    placed = numbered(df, ["v"])
    assert sorted(r["position"] for r in placed.collect()) == list(range(20_000))


def test_nothing_to_number(spark):
    assert numbered(spark.range(0), ["id"]).collect() == []
    with pytest.raises(ValueError, match="position"):
        numbered(spark.range(1).withColumnRenamed("id", "position"), ["position"])


def test_starts_are_the_sums_before(spark):
    random.seed(4)
    sizes = [(f, p, random.randint(0, 9)) for f in ("a", "b", "c") for p in range(5)]
    found = with_starts(spark.createDataFrame(sizes, "f string, p int, n long"), ["f", "p"]).collect()
    total, expected = 0, {}
    for f, p, n in sizes:
        expected[f, p] = total
        total += n
    assert {(r["f"], r["p"]): r["start"] for r in found} == expected


def test_lines_of_files_in_many_pieces(spark, tmp_path, small_pieces):
    names = []
    for file in ("2.json", "1.json", "sub.json", "0.json"):
        lines = []
        for k in range(0 if file == "sub.json" else 60):
            lines.append(json.dumps({"station_name": f"{file} {k} é", "lat": k, "lon": str(-k)}))
            if k % 11 == 0:
                lines.append("  ")
        (tmp_path / file).write_text("\n".join(lines) + "\n", encoding="utf-8")
    for file in ("0.json", "1.json", "2.json"):
        names += [f"{file} {k} é" for k in range(60)]
    lines = spark.read.text(str(tmp_path)).where(F.trim("value") != "")
    assert lines.rdd.getNumPartitions() > 12
    places = sorted(numbered_lines(lines).collect(), key=lambda r: r["position"])
    assert [json.loads(r["value"])["station_name"] for r in places] == names
    stations = sorted(read_registry(spark, str(tmp_path), lines=True).collect(), key=lambda r: r["position"])
    assert [(r["position"], r["station_name"], r["lat"], r["lon"]) for r in stations] == [
        (i, name, float(i % 60), float(-(i % 60))) for i, name in enumerate(names)
    ]


@pytest.mark.parametrize("line", ['{"station_name": "A", "lat": 1}', "[1]", "{", "null"])
def test_a_bad_line_is_fatal(spark, tmp_path, line):
    (tmp_path / "a.json").write_text('{"station_name": "A", "lat": 1, "lon": 2}\n' + line + "\n")
    with pytest.raises(Exception, match="registry entry without|MALFORMED"):
        read_registry(spark, str(tmp_path), lines=True).collect()


def test_plan_has_no_window_over_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(map(str, range(100))))
    placed = numbered_lines(spark.read.text(str(tmp_path)))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    # Windows stand above the counts of pieces only.
    assert "Window" in plan
    for window in plan.split("Window ")[1:]:
        assert "Aggregate" in window and "value#" not in window.split("Aggregate")[0]
