"""The null-safe join: rows, columns and plan."""

import pytest
from pyspark.sql import functions as F

from dayledger.operators.joining import null_safe_join


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows have one key, and those are copies; some keys are NULL."""
    big = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 2500))
        .alias("key"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("value"),
    )
    keys = [(f"k{i}", i) for i in range(0, 2500, 2)] + [("hot", -1), (None, -2), ("unused", -3)]
    return big, spark.createDataFrame(keys, "key string, number long")


def _expected(sides, how):
    big, small = sides
    numbers = {r["key"]: r["number"] for r in small.collect()}
    rows = [(r["key"], r["value"]) for r in big.collect()]
    return sorted(
        ((k, v, numbers.get(k)) for k, v in rows if how == "left" or k in numbers), key=str
    )


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_with_and_without_broadcast(spark, sides, how, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = null_safe_join(*sides, ["key"], how).select("key", "value", "number")
        assert sorted((tuple(r) for r in joined.collect()), key=str) == _expected(sides, how)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_other_columns_may_share_a_name(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        big = spark.range(3000).selectExpr("id % 10 as key", "id as note")
        small = spark.range(10).selectExpr("id as key", "id * 2 as note")
        joined = null_safe_join(big, small, ["key"])
        assert joined.columns == ["key", "note", "note"]
        assert joined.count() == 3000
        assert joined.select(small["note"]).agg(F.sum("note")).first()[0] == 300 * 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_job_starts_and_the_big_side_is_read_once(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(100).selectExpr("id as key", "id as value").write.parquet(path)
    spark.sparkContext.setJobGroup("planning", "join")
    joined = null_safe_join(spark.read.schema("key long, value long").parquet(path),
                            spark.range(10).withColumnRenamed("id", "key"), ["key"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("FileScan parquet") == 1


def test_other_join_types_are_refused(spark, sides):
    with pytest.raises(ValueError):
        null_safe_join(*sides, ["key"], "full")
