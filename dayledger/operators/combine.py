"""Base plus delta, and two tables as one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from dayledger.functions.casts import conform
from dayledger.schemas import UNIFIED


def matched(base: DataFrame, delta: DataFrame, by_position: bool = False) -> DataFrame:
    """The delta with the base's columns, matched by position.

    Unless ``by_position`` says so, columns in another order raise instead of being mixed up.
    """
    if len(base.columns) != len(delta.columns):
        raise ValueError(f"base has {len(base.columns)} columns, delta has {len(delta.columns)}")
    if by_position:
        return delta.toDF(*base.columns)
    if [c.lower() for c in base.columns] != [c.lower() for c in delta.columns]:
        raise ValueError(f"column order differs: {base.columns} and {delta.columns}")
    return delta


def base_plus_delta(
    base: DataFrame, delta: DataFrame, schema: T.StructType, by_position: bool = False
) -> DataFrame:
    """Both inputs cast to the schema, duplicates kept.

    Each side is cast before the union, so inputs of different types do not meet.
    """
    delta = matched(base, delta, by_position)
    return conform(base, schema).union(conform(delta, schema))


def union_counts(base: DataFrame, delta: DataFrame) -> DataFrame:
    """One row: rows of base, of delta and of their union. Reads no column."""
    tagged = base.select(F.lit(1).alias("is_base")).union(delta.select(F.lit(0).alias("is_base")))
    return tagged.agg(
        F.count_if(F.col("is_base") == 1).alias("base_rows"),
        F.count_if(F.col("is_base") == 0).alias("delta_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def _long_arm(df: DataFrame, data_type: str) -> DataFrame:
    """The long table's columns: the discriminator, own columns, typed NULLs for the rest."""
    own = {**{c: F.col(c) for c in df.columns}, "data_type": F.lit(data_type)}
    return df.select(
        *[
            own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in UNIFIED.fields
        ]
    )


def unified_long(delays: DataFrame, weather: DataFrame) -> DataFrame:
    return _long_arm(delays, "delay").union(_long_arm(weather, "weather"))
