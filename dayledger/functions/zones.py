"""Days of a time zone: instants to local days, and where a local day begins and ends.

Nothing here depends on the session's time zone: all is computed on microseconds since 1970, whose
offset is taken from the zone's own rules, row by row. A zone is a name such as ``Europe/Budapest``
or an offset such as ``+05:45``; a NULL zone or instant gives NULL, an unknown zone fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY = 86_400_000_000


def _shifted(instant: Column, zone: Column) -> Column:
    """Microseconds on the zone's clock."""
    return F.unix_micros(F.from_utc_timestamp(instant, zone))


def local_day(instant: Column, zone: Column) -> Column:
    """The calendar day at which the zone's clock stands at this instant."""
    return F.date_from_unix_date(F.floor(_shifted(instant, zone) / F.lit(_DAY)).cast("int"))


def local_time(instant: Column, zone: Column) -> Column:
    """Seconds on the zone's clock since its midnight."""
    return F.floor(F.pmod(_shifted(instant, zone), F.lit(_DAY)) / F.lit(1_000_000)).cast("int")


def day_start(day: Column, zone: Column) -> Column:
    """The first instant of a local day.

    Where the clock jumps over midnight, that is the first instant after the jump; where midnight
    comes twice, the first one.
    """
    midnight = F.timestamp_micros(F.unix_date(day).cast("long") * F.lit(_DAY))
    return F.to_utc_timestamp(midnight, zone)


def day_hours(day: Column, zone: Column) -> Column:
    """Length of a local day: 24, or another number on the days on which the clock changes."""
    length = F.unix_micros(day_start(F.date_add(day, 1), zone)) - F.unix_micros(day_start(day, zone))
    return length / F.lit(3_600_000_000)
