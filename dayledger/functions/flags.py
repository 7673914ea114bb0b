"""Threshold flags, 1 or 0.

NaN is never extreme, though Spark sorts it above all numbers: it is replaced by a bound,
which is not extreme itself.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag_outside(value: Column, low: float, high: float) -> Column:
    number = F.nanvl(value, F.lit(float(low)))
    return F.when((number < low) | (number > high), 1).otherwise(0)


def flag_above(value: Column, high: float) -> Column:
    return F.when(F.nanvl(value, F.lit(float(high))) > high, 1).otherwise(0)
