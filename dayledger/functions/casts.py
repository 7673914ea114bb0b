"""Casts to a fixed schema in which a bad value becomes NULL and never an error.

``try_cast`` of bad text throws and catches an exception per value, which costs far more than
the cast. A pattern keeps bad text away from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What Spark trims from text before a cast, and texts that count as numbers.
_BLANK = r"[\x00-\x20\x7f]*"
_INT_TEXT = rf"^{_BLANK}[+-]?[0-9]+(\.[0-9]*)?{_BLANK}\z"
_FRACTION_TEXT = rf"^{_BLANK}[+-]?\.[0-9]*{_BLANK}\z"
_MAYBE_DOUBLE = rf"^{_BLANK}[-+.0-9iInN]"
_INT_MAX = 2147483647
_INT_MIN = -2147483648


def _to_int(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        # '12.7' counts as 12 and '.7' as 0.
        return F.when(
            value.rlike(_INT_TEXT), F.substring_index(value, ".", 1).try_cast("int")
        ).when(value.rlike(_FRACTION_TEXT), 0)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return (
            F.when(F.isnan(value), 0)
            .when(value >= _INT_MAX, _INT_MAX)
            .when(value <= _INT_MIN, _INT_MIN)
            .otherwise(value.try_cast("int"))
        )
    if isinstance(source, T.LongType):
        # An int keeps the low 32 bits of a bigint.
        return F.shiftright(F.shiftleft(value, 32), 32).cast("int")
    return value.try_cast("int")


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return value
    if isinstance(target, T.IntegerType):
        return _to_int(value, source)
    if isinstance(target, T.DoubleType) and isinstance(source, T.StringType):
        return F.when(value.rlike(_MAYBE_DOUBLE), value.try_cast(target))
    return value.try_cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, each cast to the schema's type.

    Names are found as the session finds them: without regard to case, unless it is told so.
    """
    found = df.select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return found.select(
        *[
            lenient_cast(F.col(f"`{f.name}`"), own.dataType, f.dataType).alias(f.name)
            for f, own in zip(schema.fields, found.schema.fields, strict=True)
        ]
    )
