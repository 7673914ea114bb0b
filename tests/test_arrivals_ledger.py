"""Every arrived file once, whatever happens between two runs."""

import json
import os
from datetime import date, timedelta

import pytest

from dayledger.functions.ranges import as_day, in_ranges, merged, without
from dayledger.operators.arrivals import ArrivalError
from dayledger.plans import landing
from dayledger.plans.landing import every_arrival, every_loaded
from dayledger.sinks.publish import NoRowsError
from dayledger.sources import ledger as ledgers

DAYS = [f"2025-06-{d:02d}" for d in range(1, 31)]


def _day(n):
    return date(2025, 6, 1) + timedelta(days=n)


def _all(ranges):
    return {first + timedelta(days=k) for first, last in ranges for k in range((last - first).days + 1)}


def test_ranges_are_sets_of_days():
    import random

    random.seed(9)
    for _ in range(300):
        a, b = ([(_day(random.randint(0, 20)), _day(random.randint(0, 20))) for _ in range(random.randint(0, 4))] for _ in "ab")
        assert _all(merged(a)) == _all(a)
        assert _all(without(a, b)) == _all(a) - _all(b)
        for out in (merged(a), without(a, b)):
            assert all(x[1] + timedelta(days=1) < y[0] for x, y in zip(out, out[1:], strict=False)) or out == without(a, b)
    assert merged([(_day(0), _day(1)), (_day(2), _day(3))]) == [(_day(0), _day(3))]
    assert without([(date(1, 1, 1), date(9999, 12, 31))], [(date.min, date.max)]) == []
    assert as_day("2025-1-5") == date(2025, 1, 5)


def test_days_in_ranges(spark):
    rows = [(d,) for d in (*DAYS[:6], None, "no day")]
    df = spark.createDataFrame(rows, "d string")
    found = df.where(in_ranges(df["d"], [(_day(0), _day(1)), (_day(4), _day(4))])).collect()
    assert [r["d"] for r in found] == [*DAYS[:2], DAYS[4], None, "no day"]
    assert df.where(in_ranges(df["d"], [])).count() == 2


@pytest.fixture
def inputs(tmp_path):
    registry = tmp_path / "stations.json"
    registry.write_text("\n".join(json.dumps({"station_name": f"S{i}", "lat": 47.0, "lon": 19.5}) for i in range(20)))
    responses = tmp_path / "responses"
    responses.mkdir()
    (responses / "a.json").write_text("\n".join(json.dumps({"position": i, "status": 200, "body": json.dumps({"daily": {
        "time": DAYS, "temperature_2m_mean": [1.0] * 30, "wind_gusts_10m_max": [1.0] * 30, "precipitation_sum": [0.0] * 30}})})
        for i in range(20)))
    (tmp_path / "arrivals").mkdir()
    return {"arrivals": str(tmp_path / "arrivals"), "registry": str(registry), "responses": str(responses),
            "output": str(tmp_path / "out"), "registry_lines": True}


def _arrive(inputs, first, last, when, name=None):
    path = f"{inputs['arrivals']}/{name or f'{first}_{last}_delays.csv'}"
    with open(path, "w") as file:
        file.write("x")
    os.utime(path, (when, when))


def _loaded(spark, inputs):
    rows = every_loaded(spark, inputs["output"]).select("date", "station_name").collect()
    return sorted((r["date"], r["station_name"]) for r in rows)


def _expected(*days):
    return sorted((DAYS[d], f"S{i}") for d in days for i in range(20))


def test_three_arrivals_between_two_runs(spark, inputs):
    with pytest.raises(ArrivalError, match="no file"):
        every_arrival(spark, **inputs)
    _arrive(inputs, DAYS[0], DAYS[2], 1000)
    assert every_arrival(spark, **inputs)["files"] == 1
    assert _loaded(spark, inputs) == _expected(0, 1, 2)
    # The newest is not the last one by its days; two of them overlap, one with the first load.
    _arrive(inputs, DAYS[10], DAYS[12], 5000)
    _arrive(inputs, DAYS[2], DAYS[4], 4000)
    _arrive(inputs, DAYS[4], DAYS[6], 3000)
    _arrive(inputs, "", "", 9000, "notes.txt")
    report = every_arrival(spark, **inputs)
    assert (report["files"], report["unreadable"]) == (3, ["notes.txt"])
    assert report["total_records"] == 20 * 7 and report["unique_dates"] == 7
    assert _loaded(spark, inputs) == _expected(*range(7), 10, 11, 12)
    # Nothing new: nothing is loaded.
    assert every_arrival(spark, **inputs) == {"files": 0, "load": None, "unreadable": ["notes.txt"]}
    # The same name, written again, is a new arrival; its days are there already.
    _arrive(inputs, DAYS[4], DAYS[6], 9500)
    again = every_arrival(spark, **inputs)
    assert again["files"] == 1 and "total_records" not in again
    assert _loaded(spark, inputs) == _expected(*range(7), 10, 11, 12)
    _arrive(inputs, DAYS[6], DAYS[7], 9600)
    every_arrival(spark, **inputs)
    assert _loaded(spark, inputs) == _expected(*range(8), 10, 11, 12)


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_failed_run_loads_nothing_twice(spark, inputs, monkeypatch, step):
    _arrive(inputs, DAYS[0], DAYS[1], 1000)
    every_arrival(spark, **inputs)
    _arrive(inputs, DAYS[2], DAYS[3], 2000)
    with monkeypatch.context() as broken:

        def lost(*a, **b):
            raise OSError("lost")

        if step == "write":
            broken.setattr(landing, "replace_folder", lost)
        else:
            broken.setattr(ledgers, "commit", lost)
        with pytest.raises(OSError, match="lost"):
            every_arrival(spark, **inputs)
    # What is not in the ledger does not count, written or not.
    assert _loaded(spark, inputs) == _expected(0, 1)
    # Another file comes before the next run: another load, and the orphan folder stays unread.
    _arrive(inputs, DAYS[5], DAYS[5], 3000)
    report = every_arrival(spark, **inputs)
    assert report["files"] == 2
    assert _loaded(spark, inputs) == _expected(0, 1, 2, 3, 5)


def test_a_load_without_rows_is_tried_again(spark, inputs):
    _arrive(inputs, "2031-01-01", "2031-01-07", 1000)
    with pytest.raises(NoRowsError):
        every_arrival(spark, **inputs)
    assert _loaded(spark, inputs) == [] and ledgers.loads(spark, f"{inputs['output']}/_ledger") == []
    _arrive(inputs, DAYS[1], DAYS[0], 2000)  # ends before it begins: no day of its own
    _arrive(inputs, DAYS[3], DAYS[3], 2000)
    assert every_arrival(spark, **inputs)["files"] == 3
    assert _loaded(spark, inputs) == _expected(3)


def test_gaps_between_ranges_do_not_end_a_series(spark, inputs, tmp_path):
    body = {"time": DAYS, "temperature_2m_mean": [None if d == 4 else 1.0 for d in range(30)], "wind_gusts_10m_max": [1.0] * 30,
            "precipitation_sum": [0.0] * 30}
    line = {"position": 0, "status": 200, "body": json.dumps({"daily": body})}
    (tmp_path / "responses" / "a.json").write_text(json.dumps(line))
    _arrive(inputs, DAYS[1], DAYS[2], 1000)
    _arrive(inputs, DAYS[6], DAYS[7], 1000)
    report = every_arrival(spark, **inputs)
    assert (report["successful"], report["failed"], report["days_left_out"]) == (1, 19, 26)
    assert [d for d, _ in _loaded(spark, inputs)] == [DAYS[1], DAYS[2], DAYS[6], DAYS[7]]


def test_an_entry_is_complete_or_absent(spark, inputs, tmp_path):
    _arrive(inputs, DAYS[0], DAYS[0], 1000)
    every_arrival(spark, **inputs)
    folder = tmp_path / "out" / "_ledger"
    (folder / "_0123").write_text('{"load": "half')  # a run that was ended while it wrote
    assert len(ledgers.loads(spark, str(folder))) == 1
    assert _loaded(spark, inputs) == _expected(0)
