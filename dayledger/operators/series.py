"""Daily series in a JSON body: parallel arrays, cut at the first invalid day, exploded.

All steps work within a row, so a station's days are never shuffled or grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from dayledger.functions.ranges import Range, in_ranges
from dayledger.schemas import DAILY_SERIES

# JSON types that compare as numbers.
_NUMBER_TYPES = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"


def _numbers(value: Column) -> Column:
    """A series of mixed JSON values as doubles, in which what is no number is NULL.

    A value that is no array gives an empty series; a missing one gives NULL.
    """
    numbers = F.transform(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda x: F.when(
            F.schema_of_variant(x).rlike(_NUMBER_TYPES), F.try_variant_get(x, "$", "double")
        ),
    )
    return F.coalesce(numbers, F.when(value.isNotNull(), F.array().cast("array<double>")))


def parse_daily(
    df: DataFrame, series: dict[str, str] = DAILY_SERIES, body: str = "body"
) -> DataFrame:
    """Replace the body by ``time`` and one array of doubles per series.

    Only the named series are in the read schema, so others are skipped while parsing.
    A read of typed arrays drops a whole array for one element of another type. Bodies that
    come out incomplete are read again, with types that keep such elements apart.
    """

    def daily(kind: T.DataType, bare_names: bool) -> Column:
        fields = [T.StructField("time", T.ArrayType(T.StringType()))]
        fields += [T.StructField(field, kind) for field in series]
        schema = T.StructType([T.StructField("daily", T.StructType(fields))])
        # With bare NaN and Infinity allowed, a typed read would take the same words as text
        # for numbers, too.
        options = {
            "allowSingleQuotes": "false",
            "allowNonNumericNumbers": str(bare_names).lower(),
        }
        return F.from_json(body, schema, options)["daily"]

    kept = [c for c in df.columns if c != body]
    typed = df.select(*kept, body, daily(T.ArrayType(T.DoubleType()), False).alias("_typed"))
    incomplete = F.col("_typed.time").isNull()
    for field in series:
        incomplete = incomplete | F.col(f"_typed.{field}").isNull()
    parsed = typed.select(
        *kept, "_typed", F.when(incomplete, daily(T.VariantType(), True)).alias("_mixed")
    )
    return parsed.select(
        *kept,
        F.coalesce("_typed.time", "_mixed.time").alias("time"),
        *[
            F.coalesce(f"_typed.{field}", _numbers(F.col(f"_mixed.{field}"))).alias(name)
            for field, name in series.items()
        ],
    )


def in_range(
    day: Column, start: str | None, end: str | None, ranges: list[Range] | None = None
) -> Column:
    """Inclusive on both ends; with ``ranges``, in one of these, too. A day that is NULL or
    unreadable stays in.
    """
    wanted = F.lit(True) if ranges is None else in_ranges(day, ranges)
    if start is None and end is None:
        return wanted
    if start is not None:
        wanted = wanted & (day.try_cast("date") >= F.lit(start).cast("date"))
    if end is not None:
        wanted = wanted & (day.try_cast("date") <= F.lit(end).cast("date"))
    return F.coalesce(wanted, F.lit(True))


def valid_prefix(
    df: DataFrame,
    measures: list[str],
    required: tuple[str, ...] = (),
    start: str | None = None,
    end: str | None = None,
    time: str = "time",
    ranges: list[Range] | None = None,
) -> DataFrame:
    """Add ``keep``, the number of leading valid days, and ``status``, ok or error.

    A day is invalid if a measure is NULL or its array has ended, or if a required column
    is NULL. Days outside the range do not count. A missing array is an error; an array
    longer than ``time`` is not.
    """

    def invalid(day: Column, index: Column) -> Column:
        gap = F.lit(False)
        for name in measures:
            gap = gap | F.get(F.col(name), index).isNull()
        for name in required:
            gap = gap | F.col(name).isNull()
        return gap & in_range(day, start, end, ranges)

    complete = F.col(time).isNotNull()
    suspect = F.lit(False)
    for name in measures:
        complete = complete & F.col(name).isNotNull()
        suspect = suspect | (F.size(name) < F.size(time)) | F.exists(name, lambda x: x.isNull())
    for name in required:
        suspect = suspect | F.col(name).isNull()
    # 1-based; 0 if every day is valid. Days are looked at one by one only where the quick
    # checks found a gap somewhere.
    first_invalid = (
        F.when(~complete, 1)
        .when(suspect, F.array_position(F.transform(time, invalid), True))
        .otherwise(0)
    )
    marked = df.withColumn("_first_invalid", first_invalid.cast("int"))
    return marked.select(
        *df.columns,
        F.when(F.col("_first_invalid") > 0, F.col("_first_invalid") - 1)
        .otherwise(F.size(time))
        .alias("keep"),
        F.when(F.col("_first_invalid") > 0, "error").otherwise("ok").alias("status"),
    )


def explode_days(
    df: DataFrame,
    measures: list[str],
    carry: list[str],
    start: str | None = None,
    end: str | None = None,
    time: str = "time",
    ranges: list[Range] | None = None,
) -> DataFrame:
    """One row per kept day: the carried columns, ``day_index``, ``date``, the measures.

    Only the days are exploded; the measures are looked up by index in the same codegen
    stage, so no struct is built per day.
    """
    days = df.select(
        *carry,
        *measures,
        F.posexplode(F.slice(time, 1, F.col("keep"))).alias("day_index", "date"),
    )
    return days.where(in_range(F.col("date"), start, end, ranges)).select(
        *carry,
        "day_index",
        "date",
        *[F.get(name, F.col("day_index")).alias(name) for name in measures],
    )
