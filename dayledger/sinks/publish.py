"""Replace a published table as a whole; readers never see it half written.

Where columns and partitioning stay, one statement moves the table's location. Otherwise the
new table is made complete under a name of its own, with all partitions, and then takes the old
one's name: between these two statements of the catalog the name is free for a moment.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from dayledger.sinks.folders import write_folder


log = logging.getLogger(__name__)


class NoRowsError(RuntimeError):
    """Nothing was loaded, so nothing is published."""


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _has_columns(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    return spark.table(table).schema.simpleString() == schema.simpleString()


def expect_kind(spark: SparkSession, name: str, view: bool) -> None:
    """Fail before anything is written if the name is taken by the other kind."""
    if spark.catalog.tableExists(name):
        is_view = spark.catalog.getTable(name).tableType == "VIEW"
        if is_view != view:
            raise ValueError(f"{name} is a {'view' if is_view else 'table'}: drop it first")


def write_version(
    df: DataFrame,
    table: str,
    root: str,
    fmt: str,
    files: int | str | None = None,
    partition_by: tuple[str, ...] = (),
    **options,
) -> tuple[str, int]:
    """Write a new folder below ``root``. Returns the folder and the row count.

    The options are those of ``write_folder``.
    """
    folder = f"{root.rstrip('/')}/{table.split('.')[-1]}-{uuid.uuid4().hex}"
    return folder, write_folder(df, folder, fmt, files, "errorifexists", partition_by, **options)


def point_table(
    spark: SparkSession,
    table: str,
    folder: str,
    fmt: str,
    schema: T.StructType,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Let the table mean the files in this folder, from now on."""
    if not partition_by and _has_columns(spark, table, schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")
        refresh(spark, table)
        return
    # A partitioned table keeps a location per partition, so it is defined anew.
    made = f"{table}_{uuid.uuid4().hex}"
    try:
        define_table(spark, made, folder, fmt, schema, partition_by)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {made}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
    refresh(spark, table)


def define_table(
    spark: SparkSession,
    table: str,
    folder: str,
    fmt: str,
    schema: T.StructType,
    partition_by: tuple[str, ...] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """A new table over a finished folder, with all its partitions."""
    header = "OPTIONS (header 'true')" if fmt == "csv" else ""
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    own = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE {table} ({_columns(schema)}) USING {fmt} {header} {partitions} "
        f"LOCATION {_text(folder)} {f'TBLPROPERTIES ({own})' if own else ''}"
    )
    if partition_by:
        spark.catalog.recoverPartitions(table)


def publish_table(
    df: DataFrame,
    table: str,
    root: str,
    fmt: str,
    files: int | str | None = None,
    partition_by: tuple[str, ...] = (),
    read_schema: T.StructType | None = None,
    require_rows: bool = False,
    **options,
) -> int:
    """Write a new folder, then point the table at it. Returns the row count.

    The plan may read the table that it replaces, since the old folder is left alone. A
    failed or empty run leaves the table as it was. Old folders stay until they are cleaned
    up from outside.
    """
    expect_kind(df.sparkSession, table, view=False)
    folder, rows = write_version(df, table, root, fmt, files, partition_by, **options)
    if require_rows and rows == 0:
        raise NoRowsError(f"no rows for {table}")
    point_table(df.sparkSession, table, folder, fmt, read_schema or df.schema, partition_by)
    return rows


def publish_bucketed(
    df: DataFrame, table: str, root: str, key: tuple[str, ...], buckets: int
) -> int:
    """Publish as Parquet laid out for joins on the key. Returns the row count.

    Rows with equal keys are in the same bucket, one file each, sorted. Two tables with the same key
    and number of buckets are joined, and one is grouped, without a shuffle, after a republish too.
    A bucket is read by one task, so this is for keys none of which holds a large part of all rows;
    others belong in a plain table, whose joins adaptive execution can split.

    Readers see the old rows or the new ones, as with ``publish_table``.
    """
    spark = df.sparkSession
    expect_kind(spark, table, view=False)
    if not key or buckets < 1:
        raise ValueError("buckets need a key and a number")
    made = f"{table}_{uuid.uuid4().hex}"
    folder = f"{root.rstrip('/')}/{table.split('.')[-1]}-{uuid.uuid4().hex}"
    counted = Observation()
    # The same hash deals rows to tasks and to buckets: each task writes the one file of a bucket.
    rows = df.repartition(buckets, *key).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.format("parquet").option("path", folder)
    try:
        writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(made)
        if _has_columns(spark, table, df.schema) and _buckets(spark, table) == _buckets(spark, made):
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")
            spark.sql(f"DROP TABLE {made}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"ALTER TABLE {made} RENAME TO {table}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {made}")
        raise
    refresh(spark, table)
    return counted.get["rows"]


def _buckets(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Number of buckets and their columns, as the catalog describes them."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    wanted = ("Num Buckets", "Bucket Columns", "Sort Columns")
    rows = described.where(F.col("col_name").isin(*wanted)).collect()
    return sorted((r["col_name"], r["data_type"]) for r in rows)


def refresh(spark: SparkSession, table: str) -> None:
    try:
        spark.catalog.refreshTable(table)
    except Exception:
        # The table is published already; only this session's cached listing is old.
        log.exception("table %s was not refreshed", table)


def publish_union(spark: SparkSession, view: str, tables: list[str], columns: list[str]) -> None:
    """One name over several published tables of the same columns."""
    names = ", ".join(f"`{c}`" for c in columns)
    arms = " UNION ALL ".join(f"SELECT {names} FROM {table}" for table in tables)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {arms}")


def tables_of(spark: SparkSession, view: str) -> list[str]:
    """The tables that a published union reads, by the names in its text."""
    if not spark.catalog.tableExists(view):
        return []
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {view}")
    text = described.where("col_name = 'View Text'").first()["data_type"]
    return re.findall(r"FROM (\S+)", text)
