"""Rebuild by file: each source file is read once, however often the target is rebuilt.

The target is a view over finished tables, the generations. A generation holds the conformed rows of
some source files, each row with its file's name, and a manifest of these files beside it: path, time
and size, in the base or in the delta. A rebuild lists the sources, which opens no file, and compares
the list with the manifests:

- files that no manifest has are read and become the new generation;
- a file that is gone, or was written again, takes its rows along: the generations that have such
  rows are written again from their own output, without the rows; sources are not read for that;
- generations whose files are all there stay as they are.

One statement then points the view at the generations that hold now. With more than
``MOST_GENERATIONS``, the smaller half is folded into the new one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dayledger.functions.casts import conform
from dayledger.operators.combine import matched
from dayledger.sinks.publish import define_table, expect_kind, publish_union, tables_of, write_version
from dayledger.session import written
from dayledger.sources.tables import read_table, source_files

_SOURCE = "_source"
_MANIFEST = "dayledger.manifest"
#: Tables below a view; each rebuild that finds new files adds one.
MOST_GENERATIONS = 16
#: Paths in one condition on the files to be read.
PATHS = 5000


def _source(arm: str, path: Column, time: Column, size: Column) -> Column:
    """128 bits that stand for a file as it is now."""
    return F.md5(F.concat_ws("|", F.lit(arm), path, F.unix_micros(time), size))


def _listed(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``arm, path, time, size, _source`` of the files of base and delta."""
    arms = []
    for arm, table in tables.items():
        found = source_files(spark, table)
        own = _source(arm, F.col("path"), F.col("time"), F.col("size"))
        arms.append(found.select(F.lit(arm).alias("arm"), "path", "time", "size", own.alias(_SOURCE)))
    return arms[0].union(arms[1])


def _manifest(spark: SparkSession, generation: str) -> DataFrame:
    row = spark.sql(f"SHOW TBLPROPERTIES {generation}").where(f"key = '{_MANIFEST}'").first()
    if row is None:
        raise ValueError(f"{generation} was not made by file: drop the view first")
    return spark.read.parquet(row["value"])


def _rows_of(spark: SparkSession, arm: str, table: str, paths: list[str]) -> DataFrame:
    """A table's rows from these files alone, with their ``_source``; the scan skips all others."""
    meta = {part: F.col(f"_metadata.file_{part}") for part in ("path", "modification_time", "size")}
    own = _source(arm, meta["path"], meta["modification_time"], meta["size"]).alias(_SOURCE)
    rows = read_table(spark, table)
    parts = [
        rows.where(meta["path"].isin(paths[k : k + PATHS])).select("*", own)
        for k in range(0, len(paths), PATHS)
    ]
    return reduce(DataFrame.union, parts)


def rebuild_by_file(
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
    """The rows that ``rebuild`` would publish, made of those files only that have come since.

    Returns the number of rows written. A file that comes or changes while it is read is left to the
    next run. Both tables must have all their files in one folder.
    """
    expect_kind(spark, target, view=True)
    tables = {"base": base, "delta": delta}
    for table in tables.values():
        spark.catalog.refreshTable(table)
    matched(read_table(spark, base), read_table(spark, delta))
    now = written(_listed(spark, tables))
    before = tables_of(spark, target)
    known = {g: _manifest(spark, g) for g in before}
    everything = reduce(DataFrame.union, [m.select(_SOURCE) for m in known.values()], now.select(_SOURCE).limit(0))
    # One path per new file comes to the driver, as in any listing that Spark makes.
    new = written(now.join(everything, _SOURCE, "left_anti").select(*now.columns))
    fresh = new.select("arm", "path").collect()
    kept, stale = [], []
    for generation, manifest in known.items():
        lost = manifest.join(now, _SOURCE, "left_anti").isEmpty()
        (kept if lost else stale).append(generation)
    if before and not fresh and not stale:
        return 0
    if len(kept) >= MOST_GENERATIONS:
        sizes = {g: known[g].agg(F.sum("size")).first()[0] or 0 for g in kept}
        folded = sorted(kept, key=lambda g: (sizes[g], g))[: len(kept) // 2]
        kept, stale = [g for g in kept if g not in folded], stale + folded
    wide = T.StructType([*schema.fields, T.StructField(_SOURCE, T.StringType())])
    parts = []
    for arm, table in tables.items():
        paths = sorted(r["path"] for r in fresh if r["arm"] == arm)
        if paths:
            parts.append(conform(_rows_of(spark, arm, table, paths), wide))
    # What stays of a generation comes from its own output.
    here = now.select(_SOURCE)
    parts += [read_table(spark, g).join(here, _SOURCE, "left_semi").select(*wide.names) for g in stale]
    rows = reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], wide)
    made = f"{target}_{uuid.uuid4().hex}"
    folder, n = write_version(rows, made, root, fmt, files, **options)
    # Files that were written again meanwhile: their rows are of no known state.
    steady = _listed(spark, tables).select(_SOURCE)
    read = reduce(
        DataFrame.union,
        [known[g].join(here, _SOURCE, "left_semi").select(*now.columns) for g in stale],
        new,
    )
    lost = read.join(steady, _SOURCE, "left_anti")
    if not lost.isEmpty():
        again = spark.read.schema(wide).options(**_reading(fmt)).format(fmt).load(folder)
        sure = again.join(steady, _SOURCE, "left_semi").select(*wide.names)
        folder, n = write_version(sure, made, root, fmt, files, **options)
    manifest = f"{folder}-manifest"
    read.join(steady, _SOURCE, "left_semi").select(*now.columns).write.parquet(manifest)
    try:
        define_table(spark, made, folder, fmt, wide, properties={_MANIFEST: manifest})
        publish_union(spark, target, [*kept, made], schema.names)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {made}")
        raise
    # The old files stay for readers that have begun; the names are not needed any more.
    for table in stale:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return n


def _reading(fmt: str) -> dict[str, str]:
    return {"header": "true"} if fmt == "csv" else {}
