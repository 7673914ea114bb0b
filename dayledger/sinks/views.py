"""The long view over delays and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayledger.operators.combine import unified_long
from dayledger.schemas import UNIFIED


def _arm(table: str, data_type: str, own: set[str]) -> str:
    columns = []
    for f in UNIFIED.fields:
        value = f"`{f.name}`" if f.name in own else "NULL"
        if f.name == "data_type":
            value = f"'{data_type}'"
        columns.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
    return f"SELECT {', '.join(columns)} FROM {table}"


def create_view(spark: SparkSession, view: str, delays: str, weather: str) -> None:
    """A stored view over two catalog tables; it follows them when they are replaced."""
    arms = [
        _arm(table, kind, set(spark.table(table).columns))
        for table, kind in ((delays, "delay"), (weather, "weather"))
    ]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(arms)}")


def create_temp_view(view: str, delays: DataFrame, weather: DataFrame) -> None:
    unified_long(delays, weather).createOrReplaceTempView(view)
