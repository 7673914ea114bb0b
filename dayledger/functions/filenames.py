"""Date range in the name of an arrived file, e.g. 2025-11-24_2025-11-30_delays.csv."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dayledger.schemas import ARRIVAL_SUFFIX

# A four-digit year from 0001 on; month and day may be unpadded.
_DAY_TEXT = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
_DAY_FORMAT = "y-M-d"


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_day(text: Column) -> Column:
    return F.coalesce(
        text.rlike(_DAY_TEXT) & F.try_to_date(text, _DAY_FORMAT).isNotNull(), F.lit(False)
    )


def name_parts(name: Column, suffix: str = ARRIVAL_SUFFIX) -> Column:
    return F.split(F.replace(name, F.lit(suffix), F.lit("")), "_")


def date_range(name: Column, suffix: str = ARRIVAL_SUFFIX) -> Column:
    """struct<start_date, end_date, valid>; the dates as written, parts beyond two ignored."""
    parts = name_parts(name, suffix)
    start, end = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.struct(
        start.alias("start_date"),
        end.alias("end_date"),
        ((F.size(parts) >= 2) & is_day(start) & is_day(end)).alias("valid"),
    )
