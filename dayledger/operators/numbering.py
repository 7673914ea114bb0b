"""Places 0, 1, 2, ... in an order, for tables that no single task could number.

Rows are brought into order range by range and written; each file is then one stretch of the order,
in which a row's place is known. Rows are counted per stretch, and the prefix sums of these counts
(one row per stretch, never one per row) say where each stretch begins. No window and no task goes
over all rows, and since the stretches are files, a lost executor changes no place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayledger.session import written


def with_starts(sizes: DataFrame, order: list[str], n: str = "n", into: str = "start") -> DataFrame:
    """Add where each stretch begins: the sum of the sizes before it.

    The first column of the order, e.g. the file, is summed up by itself first, so that the last
    step goes over one row per value of it.
    """
    first, *rest = order
    inner = Window.partitionBy(first).orderBy(*rest) if rest else Window.partitionBy(first).orderBy(first)
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    per_first = sizes.groupBy(first).agg(F.sum(n).alias("_n"))
    before = per_first.select(
        F.col(first).alias("_first"), F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before")
    )
    placed = sizes.withColumn("_within", F.coalesce(F.sum(n).over(inner), F.lit(0)))
    return placed.join(before, placed[first].eqNullSafe(before["_first"])).select(
        *sizes.columns, (F.col("_before") + F.col("_within")).alias(into)
    )


def numbered(df: DataFrame, order: list[str | Column], into: str = "position") -> DataFrame:
    """Add each row's place (long, from 0) in the order.

    Equal rows of the order are numbered in some order of their own. They may be a third of all: they
    are told apart by a hash and by where they were read, so that they too are dealt to several tasks.
    """
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    apart = [F.xxhash64(*df.columns).alias("_hash"), F.monotonically_increasing_id().alias("_read")]
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    marked = df.select("*", *apart)
    ordered = marked.repartitionByRange(*keys, "_hash", "_read").sortWithinPartitions(
        *keys, "_hash", "_read"
    )
    stored = written(ordered.drop("_hash", "_read"))
    # Files are numbered as their partitions are.
    stretch = F.regexp_extract(F.col("_metadata.file_name"), "^part-([0-9]+)", 1).cast("int")
    rows = stored.select("*", stretch.alias("_stretch"), F.col("_metadata.row_index").alias("_place"))
    sizes = rows.groupBy("_stretch").agg(F.count(F.lit(1)).alias("n"))
    starts = with_starts(sizes, ["_stretch"]).select("_stretch", "start")
    return rows.join(starts, "_stretch").select(
        *df.columns, (F.col("start") + F.col("_place")).alias(into)
    )


def numbered_lines(lines: DataFrame, into: str = "position") -> DataFrame:
    """Lines of text files, as ``spark.read.text`` gives them, with their place in all of them.

    The order is that of the files' paths, then that within the file. Large files may be read in
    several pieces. ``lines`` may be filtered; what is left is numbered without gaps.
    """
    # A piece of a file is read by one task, from its first line to its last.
    read = lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_from"),
        F.monotonically_increasing_id().alias("_read"),
    )
    stored = written(read)
    pieces = stored.groupBy("_file", "_from").agg(
        F.count(F.lit(1)).alias("n"), F.min("_read").alias("_least")
    )
    pieces = with_starts(pieces, ["_file", "_from"]).select("_file", "_from", "start", "_least")
    joined = stored.join(pieces, ["_file", "_from"])
    return joined.select(
        *lines.columns, (F.col("start") + F.col("_read") - F.col("_least")).alias(into)
    )
