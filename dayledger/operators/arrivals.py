"""The newest arrived file and its date range."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayledger.functions.filenames import date_range


class ArrivalError(ValueError):
    """No file has arrived, or its name holds no date range."""


def newest(manifest: DataFrame, time: str = "modificationTime", tie: str = "path") -> DataFrame:
    """The row with the greatest time; of several, the one with the smallest tie column.

    Sort and limit are planned as one top-1 per partition, so one row per partition moves.
    """
    return manifest.orderBy(F.col(time).desc(), F.col(tie).asc()).limit(1)


def with_date_range(manifest: DataFrame, name: str = "name") -> DataFrame:
    """Add start_date, end_date and valid, read from the file name."""
    ranged = manifest.withColumn("_range", date_range(F.col(name)))
    return ranged.select(*manifest.columns, "_range.*")


def newest_range(manifest: DataFrame) -> tuple[str, str]:
    """Start and end date of the newest file, as written in its name."""
    row = with_date_range(newest(manifest)).first()
    if row is None:
        raise ArrivalError("no file has arrived")
    if not row["valid"]:
        raise ArrivalError(f"no date range in file name: {row['name']!r}")
    return row["start_date"], row["end_date"]
