"""Joins on keys in which NULL equals NULL."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame


def null_safe_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """Inner, left, semi or anti join, planned by Spark.

    The key columns come from the big side; other columns of equal names stay apart only by
    their side. Nothing is measured beforehand: adaptive execution broadcasts the side that
    turns out small and splits the keys that turn out hot.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    renamed = small.withColumnsRenamed({key: f"_right_{key}" for key in on})
    matches = reduce(and_, [big[key].eqNullSafe(renamed[f"_right_{key}"]) for key in on])
    return big.join(renamed, matches, how).drop(*[f"_right_{key}" for key in on])
