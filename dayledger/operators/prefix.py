"""Valid prefix over rows that are already exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayledger.operators.joining import null_safe_join


def valid_prefix_rows(df: DataFrame, keys: list[str], position: str, bad: Column) -> DataFrame:
    """Rows of each key strictly before the key's first bad position.

    A NULL position sorts before all others, as in an ascending order: a bad row without a
    position takes its whole key along, a good one stays.

    A window over the key would bring all rows of a key into one task. Here each key's
    first bad position is aggregated, map side first, and joined back, so a key with a third
    of all rows stays spread.
    """
    first_bad = (
        df.where(bad)
        .groupBy(*keys)
        .agg(
            F.min(position).alias("_first_bad"),
            F.bool_or(F.col(position).isNull()).alias("_from_start"),
        )
    )
    joined = null_safe_join(df, first_bad, keys, "left")
    before = F.col(position).isNull() | (F.col(position) < F.col("_first_bad"))
    clean = F.col("_from_start").isNull()
    return joined.where(clean | (~F.col("_from_start") & before)).drop("_first_bad", "_from_start")
