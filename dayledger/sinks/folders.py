"""CSV and Parquet folders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from dayledger.functions.zorder import with_z_key
from dayledger.sources.tables import file_system

# Writer options of the published Parquet table.
PARQUET_OPTIONS = {
    "parquet.enable.dictionary": "false",
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
}


class Totals:
    """Aggregates of written rows; their values are there when the write is done.

    They come to the driver, so each must be small: sums, sketches, or sets of few values.
    """

    def __init__(self, *columns: Column) -> None:
        self.columns = columns
        self.values: dict = {}


def shaped(
    df: DataFrame,
    files: int | str | None,
    cluster_by: tuple[str, ...] = (),
    z_order: tuple[str, ...] = (),
) -> DataFrame:
    """How rows are spread over files.

    None keeps the partitions as they are, without a shuffle. "auto" lets adaptive execution
    merge small partitions and cut large ones. A number gives that many files at most, unless
    one of them would be large: then adaptive execution cuts it, so that no task gets all.

    ``cluster_by`` brings rows with equal values together, so that later scans can skip files
    by their minimum and maximum. Large groups are cut as with "auto".

    ``z_order`` lays rows out so that files can be skipped by each of several columns: they are dealt
    by ranges of a key in which all the columns have part. ``files`` is then the number of ranges;
    rows that are equal in the key are dealt out, too.
    """
    if z_order:
        if cluster_by:
            raise ValueError("rows are laid out by cluster_by or by z_order")
        keyed = with_z_key(df, z_order, "_z").withColumn("_apart", F.xxhash64(*df.columns))
        ranged = (
            keyed.repartitionByRange(files, "_z", "_apart")
            if isinstance(files, int)
            else keyed.repartitionByRange("_z", "_apart")
        )
        return ranged.sortWithinPartitions("_z", *z_order).drop("_z", "_apart")
    if cluster_by or files == "auto":
        return df.hint("rebalance", *cluster_by)
    if files is None:
        return df
    return df.hint("rebalance", files)


def write_folder(
    df: DataFrame,
    path: str,
    fmt: str,
    files: int | str | None = None,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
    cluster_by: tuple[str, ...] = (),
    totals: Totals | None = None,
    z_order: tuple[str, ...] = (),
    **options: str,
) -> int:
    """Write and return the number of rows, counted by the writing tasks themselves.

    ``totals`` are further aggregates of the rows, taken in the same pass.
    """
    if files == "auto":
        cluster_by = cluster_by or partition_by
    if fmt == "csv":
        options = {"header": "true", **options}
    counted = Observation()
    # Above the shuffle, if there is one: a map task that runs again would count twice.
    rows = shaped(df, files, cluster_by, z_order).observe(
        counted, F.count(F.lit(1)).alias("rows"), *(totals.columns if totals else ())
    )
    writer = rows.write.mode(mode).options(**options).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    found = counted.get
    if totals:
        totals.values = {k: v for k, v in found.items() if k != "rows"}
    return found["rows"]


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another, which goes only when that is done.

    Between two renames there is no folder; if the second one fails, the old one comes back.
    """
    new, files = file_system(spark, staged)
    target, _ = file_system(spark, path.rstrip("/"))
    old, _ = file_system(spark, f"{path.rstrip('/')}._old-{uuid.uuid4().hex}")
    had = files.exists(target)
    if had and not files.rename(target, old):
        raise OSError(f"{path} was not replaced")
    if not files.rename(new, target):
        if had:
            files.rename(old, target)
        raise OSError(f"{path} was not replaced; the new rows are in {staged}")
    if had:
        files.delete(old, True)


def discard_folder(spark: SparkSession, path: str) -> None:
    place, files = file_system(spark, path)
    files.delete(place, True)
