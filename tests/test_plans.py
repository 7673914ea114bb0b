"""What the plans must and must not contain."""

import re

import pytest

from __spark_entry__ import _QUERIES, queries

SF_DIR = "/root/testdata/sf0.001"
# Queries whose rows stay in the task that read them.
NARROW = ["conform_cast", "conform_bad_values", "float_narrow_text", "extreme_band",
          "extreme_above", "json_fields", "explode_series", "word_series",
          "batch_numbers", "date_window", "base_plus_delta", "unified_long", "file_date_range",
          "last_path_segment", "registry_join", "weather_load", "weather_update"]
# Of responses landed again one is chosen, and text is no fixed-size aggregate.
SORTED = ["weather_outcome", "weather_report"]
# One row for each piece of a file is summed up, never one for each entry.
PIECES = ["registry_file"]


def _plan(spark, name):
    df = queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(_QUERIES))
def test_no_operator_that_does_not_scale(spark, name):
    plan = _plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Pandas",
                 "CollectLimit", "SortAggregate"):
        known = word == "SortAggregate" and name in SORTED or word == "Window" and name in PIECES
        assert word not in plan or known, plan


@pytest.mark.parametrize("name", ["load_summary", "weather_report"])
def test_rows_are_not_multiplied_for_distinct_counts(spark, name):
    assert "Expand" not in _plan(spark, name)


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "Exchange hashpartitioning" not in plan
    assert "Exchange SinglePartition" not in plan


def test_filter_reaches_the_scan(spark):
    plan = _plan(spark, "date_window")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


@pytest.mark.parametrize(
    "name, columns",
    [("unified_view", {"l_quantity", "l_shipdate", "ts", "props"}),
     ("load_summary", {"ts", "user_id", "value", "props"}),
     ("latest_arrival", {"o_orderkey", "o_orderdate"}),
     ("union_counts", {"l_shipdate"}),
     ("valid_prefix",
      {"event_id", "ts", "user_id", "value", "event_type"})],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", _plan(spark, name))
    assert {c.split(":")[0] for s in schemas for c in s.split(",")} == columns
