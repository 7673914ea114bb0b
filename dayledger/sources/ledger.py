"""Which arrived files have been loaded: a folder with one small file per load.

A load is what became of some arrived files. It counts from the moment at which its entry stands in
the ledger, which is one rename; what a failed run has written before that is never read. The same
files make the same load, so a run that is repeated replaces what it left, and adds nothing twice.
"""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.functions.ranges import Range, as_day, merged
from dayledger.operators.arrivals import ArrivalError, with_date_range
from dayledger.sources.tables import file_system

_ENTRY = (
    "load string, path string, modificationTime timestamp, start_date date, end_date date, "
    "report string"
)


class Arrival(NamedTuple):
    path: str
    #: Milliseconds since 1970: the same name, written again, is another arrival.
    time: int
    days: Range


class Pending(NamedTuple):
    arrivals: list[Arrival]
    #: Files whose names hold no date range; they are never loaded, and named in each report.
    unreadable: list[str]

    @property
    def load(self) -> str:
        """The name of the load of just these files."""
        known = sorted((a.path, a.time) for a in self.arrivals)
        return hashlib.sha256(json.dumps(known).encode()).hexdigest()[:32]


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """All loaded files, with the load that each is in."""
    place, files = file_system(spark, ledger)
    if not files.exists(place):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).json(ledger)


def pending(spark: SparkSession, listing: DataFrame, ledger: str) -> Pending:
    """The listed files that no load has, the oldest first.

    Raises if nothing is listed at all. Only these files' names come to the driver, as a listing
    does anyway.
    """
    if listing.isEmpty():
        raise ArrivalError("no file has arrived")
    done = entries(spark, ledger).select("path", "modificationTime")
    new = listing.join(done, ["path", "modificationTime"], "left_anti")
    rows = with_date_range(new).orderBy("modificationTime", "path").collect()
    arrivals = [
        Arrival(r["path"], round(r["modificationTime"].timestamp() * 1000),
                (as_day(r["start_date"]), as_day(r["end_date"])))
        for r in rows if r["valid"]
    ]
    return Pending(arrivals, [r["name"] for r in rows if not r["valid"]])


def loaded_days(spark: SparkSession, ledger: str) -> list[Range]:
    """The days of all loads."""
    rows = entries(spark, ledger).select("start_date", "end_date").distinct().collect()
    return merged([(r["start_date"], r["end_date"]) for r in rows])


def loads(spark: SparkSession, ledger: str) -> list[str]:
    return sorted(r["load"] for r in entries(spark, ledger).select("load").distinct().collect())


def _instant(millis: int) -> str:
    return datetime.fromtimestamp(millis / 1000, UTC).isoformat(timespec="milliseconds")


def commit(spark: SparkSession, ledger: str, found: Pending, report: dict) -> None:
    """Enter a finished load. An entry is complete when it gets its name, and is never changed."""

    lines = [
        json.dumps({
            "load": found.load, "path": a.path, "modificationTime": _instant(a.time),
            "start_date": a.days[0].isoformat(), "end_date": a.days[1].isoformat(), "report": json.dumps(report),
        })
        for a in found.arrivals
    ]
    target, files = file_system(spark, f"{ledger.rstrip('/')}/{found.load}.json")
    if files.exists(target):
        return
    staged, _ = file_system(spark, f"{ledger.rstrip('/')}/_{found.load}")
    out = files.create(staged, True)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    if not files.rename(staged, target) and not files.exists(target):
        raise OSError(f"load {found.load} was not entered")
