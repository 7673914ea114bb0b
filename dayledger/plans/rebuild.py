"""Rebuild the published tables from base and delta, then the view over them."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession, types as T

from dayledger.functions.casts import conform
from dayledger.operators.combine import base_plus_delta, matched
from dayledger.plans.by_file import rebuild_by_file
from dayledger.schemas import DELAYS, WEATHER
from dayledger.sinks.folders import PARQUET_OPTIONS
from dayledger.sinks.publish import (
    define_table,
    expect_kind,
    publish_table,
    publish_union,
    tables_of,
    write_version,
)
from dayledger.sinks.views import create_view
from dayledger.sources.tables import files_fingerprint, read_table

log = logging.getLogger(__name__)

_SOURCE_FILES = "dayledger.source_files"


def rebuild(
    spark: SparkSession,
    base: str,
    delta: str,
    target: str,
    schema: T.StructType,
    root: str,
    fmt: str,
    files: int | str | None = None,
    **options,
) -> int:
    """Publish base plus delta as the target table. Each input is read once.

    Returns the number of rows.
    """
    _look_again(spark, base, delta)
    merged = base_plus_delta(read_table(spark, base), read_table(spark, delta), schema)
    return publish_table(merged, target, root, fmt, files, **options)


def _look_again(spark: SparkSession, *tables: str) -> None:
    """Forget cached listings: files may have come or gone since this session last looked."""
    for table in tables:
        spark.catalog.refreshTable(table)


def rebuild_changed(
    spark: SparkSession,
    base: str,
    delta: str,
    target: str,
    schema: T.StructType,
    root: str,
    fmt: str,
    files: int | str | None = None,
    **options,
) -> int:
    """The same rows under the same name, but a large base is written only when it changes.

    The target is a view over finished tables, one for the base and one for the delta. The
    base's table remembers the files it was made from; if they are still the same, it stays
    and only the delta is written. One statement then points the view at the new tables, so
    that readers see old base and delta or new ones. Returns the number of rows written.

    What is remembered are the files before the base is read, and only if they are the same
    after it is written: a file that comes meanwhile is found by the next run.
    """
    expect_kind(spark, target, view=True)
    _look_again(spark, base, delta)
    fingerprint = files_fingerprint(spark, base)
    kept = _base_of(spark, target, fingerprint)
    base_rows = read_table(spark, base)
    changed = {"delta": matched(base_rows, read_table(spark, delta))}
    if kept is None:
        changed["base"] = base_rows
    made, rows = {}, 0
    for part, part_rows in changed.items():
        table = f"{target}_{part}_{uuid.uuid4().hex}"
        folder, n = write_version(conform(part_rows, schema), table, root, fmt, files, **options)
        made[part], rows = (table, folder), rows + n
    before = tables_of(spark, target)
    try:
        for part, (table, folder) in made.items():
            remembered = {}
            if part == "base" and fingerprint and fingerprint == files_fingerprint(spark, base):
                remembered[_SOURCE_FILES] = fingerprint
            define_table(spark, table, folder, fmt, schema, properties=remembered)
        tables = [kept or made["base"][0], made["delta"][0]]
        publish_union(spark, target, tables, schema.names)
    except Exception:
        for table, _ in made.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    # The old files stay for readers that have begun; the names are not needed any more.
    for table in before:
        if table not in tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return rows


def _base_of(spark: SparkSession, view: str, fingerprint: str | None) -> str | None:
    """The view's base table, if it was made from just these files."""
    for table in tables_of(spark, view)[:1]:
        properties = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{_SOURCE_FILES}'")
        row = properties.first()
        if fingerprint is not None and row and row["value"] == fingerprint:
            return table
    return None


def _job(changed_only: bool, by_file: bool) -> Callable[..., int]:
    if changed_only and by_file:
        raise ValueError("changed_only writes a changed base as a whole, by_file its files: choose one")
    return rebuild_by_file if by_file else rebuild_changed if changed_only else rebuild


def rebuild_weather(
    spark: SparkSession,
    root: str,
    base: str = "weather_initial",
    delta: str = "weather_last_week",
    target: str = "weather_all",
    delays: str = "delays_all",
    view: str = "unified_all",
    files: int | str | None = None,
    changed_only: bool = False,
    cluster_by: tuple[str, ...] = (),
    plain: bool = False,
    by_file: bool = False,
) -> int:
    """``plain`` writes without dictionaries, for readers that need it; files grow by far."""
    job = _job(changed_only, by_file)
    options = {"cluster_by": tuple(cluster_by), **(PARQUET_OPTIONS if plain else {})}
    rows = job(spark, base, delta, target, WEATHER, root, "parquet", files, **options)
    try:
        create_view(spark, view, delays, target)
    except Exception:
        # The table is published; a missing view must not undo that.
        log.exception("view %s was not created", view)
    return rows


def rebuild_delays(
    spark: SparkSession,
    root: str,
    base: str = "delays_initial",
    delta: str = "delays_last_week",
    target: str = "delays_all",
    files: int | str | None = None,
    changed_only: bool = False,
    by_file: bool = False,
) -> int:
    job = _job(changed_only, by_file)
    return job(spark, base, delta, target, DELAYS, root, "csv", files)


def rebuild_all(
    spark: SparkSession,
    root: str,
    files: int | str | None = None,
    changed_only: bool = False,
    cluster_by: tuple[str, ...] = (),
    plain: bool = False,
    by_file: bool = False,
) -> dict[str, int]:
    """Delays first, since the view that follows the weather reads both."""
    options = {"files": files, "changed_only": changed_only, "by_file": by_file}
    return {
        "delays": rebuild_delays(spark, root, **options),
        "weather": rebuild_weather(spark, root, **options, cluster_by=cluster_by, plain=plain),
    }
