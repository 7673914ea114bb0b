"""Sets of days as lists of ranges, both ends included."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

#: First and last day.
Range = tuple[date, date]

_DAY = timedelta(days=1)


def as_day(text: str) -> date:
    """A day as arrived names write it, padded or not."""
    year, month, day = map(int, text.split("-"))
    return date(year, month, day)


def merged(ranges: list[Range]) -> list[Range]:
    """The same days in as few ranges as possible, in order. A range that ends before it begins
    holds no day.
    """
    out: list[Range] = []
    for first, last in sorted(r for r in ranges if r[0] <= r[1]):
        if out and (first <= out[-1][1] or first - _DAY == out[-1][1]):
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def without(ranges: list[Range], gone: list[Range]) -> list[Range]:
    """The days of the first that are not in the second."""
    left = merged(ranges)
    for start, end in merged(gone):
        cut: list[Range] = []
        for first, last in left:
            if last < start or first > end:
                cut.append((first, last))
                continue
            if first < start:
                cut.append((first, start - _DAY))
            if last > end:
                cut.append((end + _DAY, last))
        left = cut
    return left


def in_ranges(day: Column, ranges: list[Range]) -> Column:
    """Whether a day (text or date) is in one of the ranges. NULL and unreadable days are."""
    value = day.try_cast("date")
    wanted = F.lit(False)
    for first, last in merged(ranges):
        wanted = wanted | value.between(F.lit(first), F.lit(last))
    return F.coalesce(F.when(value.isNotNull(), wanted), F.lit(True))
