"""Spark session and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where neither the submit command nor the cluster's defaults say otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

def build_session(name: str = "dayledger", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SETTINGS.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names.

    Where the setting is missing, a local session works beside its tables, in the
    warehouse; on a cluster the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_working"
    return f"{shared.rstrip('/')}/dayledger-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Compute once: write to the shared folder and read back.

    The result has no lineage, so losing an executor later costs a file read, and
    its size is known. ``compression`` is Parquet's, the session's if not given.
    """
    folder = working_folder(df.sparkSession)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
