"""Tables by catalog name or path, and the listing of a folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)


def read_folder(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, **options
) -> DataFrame:
    """Files with a known schema; nothing is inferred, so nothing is read twice."""
    if fmt == "csv":
        options = {"header": "true", **options}
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


# Fixed value: scheme and host in front of a path.
_ROOT = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime, length) of all files below a folder.

    Without the content column, Spark lists the files and opens none. The lookup is recursive
    so that subfolders are not taken for partitions.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "modificationTime", "length")


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime, name) of the files directly in a folder.

    The file system is asked for this one folder; Spark's readers would list all below it.
    Names that begin with ``_`` or ``.`` are left out, as in Spark's own listings.
    """
    if not folder.startswith("/") and not re.match(_ROOT, folder):
        raise ValueError(f"not an absolute path: {folder}")
    place, files = file_system(spark, folder)
    found = [f for f in files.listStatus(place) if f.isFile()]
    rows = [
        (f.getPath().toString(), f.getModificationTime(), f.getPath().getName())
        for f in found
        if not f.getPath().getName().startswith(("_", "."))
    ]
    listed = spark.createDataFrame(rows, "path string, millis long, name string")
    return listed.select("path", F.timestamp_millis("millis").alias("modificationTime"), "name")


def file_system(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Hadoop's own objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


# Fixed value: scheme and slashes in front of a path.
_SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:/*|^/*"


def table_folder(spark: SparkSession, table: str) -> str | None:
    """Where a table's files are; None if they are not all in one folder."""
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    # A column may be called Location, too, but no type has a slash.
    location = (
        described.where("col_name = 'Location' AND contains(data_type, '/')")
        .select("data_type")
        .first()
    )
    return location and location[0]


def source_files(spark: SparkSession, table: str) -> DataFrame:
    """(path, time, size) of a table's files, each as rows of it have them in ``_metadata``.

    A table reads the files directly in its folder; those in subfolders are none of its own.
    """
    folder = table_folder(spark, table)
    if folder is None:
        raise ValueError(f"the files of {table} are not all in one folder")
    place, files = file_system(spark, folder)
    if not files.exists(place):
        return spark.createDataFrame([], "path string, time timestamp, size long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    depth = len(re.sub(_SCHEME, "", folder.rstrip("/")).split("/"))
    path = F.col("_metadata.file_path")
    return files.where(F.size(F.split(F.regexp_replace(path, _SCHEME, ""), "/")) == depth + 1).select(
        path.alias("path"),
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_size").alias("size"),
    )


def files_fingerprint(spark: SparkSession, table: str) -> str | None:
    """Changes whenever a file of the table is added, removed or rewritten.

    None if the table's files are not all in one folder.
    """
    location = table_folder(spark, table)
    if location is None:
        return None
    found = (
        _files(spark, location)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash"),
        )
        .first()
    )
    return f"{found['files']}-{found['bytes']}-{found['hash']}"


def days_between(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows of a date or timestamp column from start to end, both days included.

    The column stays bare in the comparison, so the filter reaches the file scan.
    """
    first = F.lit(start).cast("date")
    after = F.date_add(F.lit(end).cast("date"), 1)
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= first.cast(kind)) & (F.col(column) < after.cast(kind)))
