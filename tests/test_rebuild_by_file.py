"""Rebuilds that read each source file once."""

import os
import random
from collections import Counter

import pytest

from dayledger.plans import by_file
from dayledger.plans.rebuild import rebuild_delays, rebuild_weather
from dayledger.schemas import DELAYS, WEATHER
from dayledger.sinks.publish import tables_of

HEAD = ",".join(DELAYS.names)


def _write(path, rows, when=None):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("\n".join([HEAD, *(f"2025-06-01,{s},{v}.0,1,1.0" for s, v in rows)]) + "\n")
    if when:
        os.utime(path, (when, when))


@pytest.fixture
def tables(spark, tmp_path, request):
    prefix = f"bf_{abs(hash(request.node.name)) % 10**9}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DELAYS.fields)
    names = {}
    for arm in ("base", "delta"):
        (tmp_path / arm).mkdir()
        names[arm] = f"{prefix}_{arm}"
        spark.sql(f"CREATE TABLE {names[arm]} ({columns}) USING csv OPTIONS (header 'true') LOCATION '{tmp_path / arm}'")
    names["target"] = f"{prefix}_all"
    yield names
    spark.sql(f"DROP VIEW IF EXISTS {names['target']}")
    for arm in ("base", "delta"):
        spark.sql(f"DROP TABLE {names[arm]}")


def _run(spark, tmp_path, tables, **options):
    return rebuild_delays(spark, str(tmp_path / "out"), **tables, by_file=True, **options)


def _rows(spark, tables):
    rows = spark.table(tables["target"]).collect()
    return Counter((r["station_name"], r["total_delay_minutes"]) for r in rows)


def test_only_new_files_are_read(spark, tmp_path, tables):
    _write(tmp_path / "base" / "a b.csv", [("A", 1), ("A", 1)], 1000)
    _write(tmp_path / "delta" / "d.csv", [("D", 4)], 1000)
    assert _run(spark, tmp_path, tables) == 3
    assert _rows(spark, tables) == {("A", 1.0): 2, ("D", 4.0): 1}
    assert spark.table(tables["target"]).columns == DELAYS.names
    assert _run(spark, tmp_path, tables) == 0
    # From now on the old file holds other rows of the same length and time: who reads it is found out.
    _write(tmp_path / "base" / "a b.csv", [("X", 9), ("X", 9)], 1000)
    _write(tmp_path / "base" / "b.csv", [("B", 2)])
    # The table reads no subfolders.
    _write(tmp_path / "base" / "sub" / "c.csv", [("C", 3)])
    assert _run(spark, tmp_path, tables) == 1
    assert _rows(spark, tables) == {("A", 1.0): 2, ("D", 4.0): 1, ("B", 2.0): 1}
    assert len(tables_of(spark, tables["target"])) == 2


def test_changed_and_removed_files(spark, tmp_path, tables):
    for name in "abc":
        _write(tmp_path / "base" / f"{name}.csv", [(name, 1)], 1000)
    _write(tmp_path / "delta" / "d.csv", [("d", 1)], 1000)
    assert _run(spark, tmp_path, tables) == 4
    _write(tmp_path / "base" / "b.csv", [("b", 2), ("b", 3)], 2000)
    (tmp_path / "base" / "c.csv").unlink()
    # Two new rows, and the rows of a and d from the generation, not from their files.
    _write(tmp_path / "base" / "a.csv", [("z", 9)], 1000)
    assert _run(spark, tmp_path, tables) == 4
    assert _rows(spark, tables) == {("a", 1.0): 1, ("b", 2.0): 1, ("b", 3.0): 1, ("d", 1.0): 1}
    (tmp_path / "delta" / "d.csv").unlink()
    _write(tmp_path / "delta" / "e.csv", [("e", 5)])
    _run(spark, tmp_path, tables)
    assert _rows(spark, tables) == {("a", 1.0): 1, ("b", 2.0): 1, ("b", 3.0): 1, ("e", 5.0): 1}
    for path in [*(tmp_path / "base").rglob("*.csv"), *(tmp_path / "delta").rglob("*.csv")]:
        path.unlink()
    assert _run(spark, tmp_path, tables) == 0
    assert _rows(spark, tables) == {}


def test_many_rebuilds_equal_one(spark, tmp_path, tables, monkeypatch):
    monkeypatch.setattr(by_file, "MOST_GENERATIONS", 3)
    monkeypatch.setattr(by_file, "PATHS", 2)
    random.seed(6)
    there = {}
    for step in range(7):
        for _ in range(random.randint(1, 4)):
            arm, name = random.choice(["base", "delta"]), random.choice("abcdef")
            path = tmp_path / arm / f"{name}.csv"
            if path.exists() and random.random() < 0.3:
                path.unlink()
                del there[path]
            else:
                there[path] = [(f"{arm}{name}{step}", random.randint(0, 3)) for _ in range(random.randint(0, 3))]
                _write(path, there[path], 1000 + step)
        _run(spark, tmp_path, tables)
        assert _rows(spark, tables) == Counter((s, float(v)) for rows in there.values() for s, v in rows), step
        assert len(tables_of(spark, tables["target"])) <= 4


def test_a_file_written_while_it_is_read_is_left_to_the_next_run(spark, tmp_path, tables, monkeypatch):
    _write(tmp_path / "base" / "a.csv", [("a", 1)], 1000)
    _write(tmp_path / "base" / "b.csv", [("b", 1)], 1000)
    write = by_file.write_version

    def slow(*given, **options):
        done = write(*given, **options)
        _write(tmp_path / "base" / "b.csv", [("b", 7)], 3000)
        _write(tmp_path / "base" / "late.csv", [("l", 1)], 3000)
        return done

    with monkeypatch.context() as patched:
        patched.setattr(by_file, "write_version", slow)
        _run(spark, tmp_path, tables)
    assert _rows(spark, tables) == {("a", 1.0): 1}
    assert _run(spark, tmp_path, tables) == 2
    assert _rows(spark, tables) == {("a", 1.0): 1, ("b", 7.0): 1, ("l", 1.0): 1}


def test_a_failed_run_leaves_the_view(spark, tmp_path, tables, monkeypatch):
    _write(tmp_path / "base" / "a.csv", [("a", 1)], 1000)
    _run(spark, tmp_path, tables)
    _write(tmp_path / "base" / "b.csv", [("b", 1)], 1000)
    with monkeypatch.context() as broken:
        broken.setattr(by_file, "publish_union", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            _run(spark, tmp_path, tables)
    assert _rows(spark, tables) == {("a", 1.0): 1}
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{tables['target']}_")]
    assert len(left) == 1
    assert _run(spark, tmp_path, tables) == 1
    assert _rows(spark, tables) == {("a", 1.0): 1, ("b", 1.0): 1}


def test_only_one_way_at_a_time(spark, tmp_path, tables):
    with pytest.raises(ValueError, match="choose one"):
        _run(spark, tmp_path, tables, changed_only=True)
    spark.sql(f"CREATE VIEW {tables['target']} AS SELECT * FROM {tables['base']}")
    with pytest.raises(ValueError, match="not made by file"):
        _run(spark, tmp_path, tables)


def test_weather_in_parquet(spark, tmp_path):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in WEATHER.fields)
    for name in ("bfw_base", "bfw_delta"):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{tmp_path / name}'")
    row = "SELECT DATE'2025-06-01', 'S', 1D, 2D, 3D, 4D, 5D, 0, 0, 1"
    spark.sql(f"INSERT INTO bfw_base {row}")
    names = {"base": "bfw_base", "delta": "bfw_delta", "target": "bfw_all", "delays": "none", "view": "none"}
    assert rebuild_weather(spark, str(tmp_path / "out"), **names, by_file=True, plain=True) == 1
    spark.sql(f"INSERT INTO bfw_delta {row}")
    assert rebuild_weather(spark, str(tmp_path / "out"), **names, by_file=True, cluster_by=("date",)) == 1
    assert spark.table("bfw_all").count() == 2 and spark.table("bfw_all").schema == WEATHER
    spark.sql("DROP VIEW bfw_all")
