"""Landed responses: one row per station with the JSON text of its daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayledger.schemas import RESPONSES
from dayledger.sources.tables import read_folder


def read_responses(
    spark: SparkSession, path: str, fmt: str = "json", on: tuple[str, ...] = ("position",)
) -> DataFrame:
    """``_file`` tells the files apart, so that of responses landed again one can be chosen."""
    landed = read_folder(spark, path, fmt, RESPONSES)
    return usable(landed.withColumn("_file", F.xxhash64("_metadata.file_path")), on)


def usable(responses: DataFrame, on: tuple[str, ...] = ("position",)) -> DataFrame:
    """The key and the body, which is NULL for a failed request: its station is an error."""
    failed = F.coalesce(F.col("status").between(400, 599), F.lit(False))
    own = ["_file"] if "_file" in responses.columns else []
    return responses.select(*on, F.when(~failed, F.col("body")).alias("body"), *own)


def checked_lines(
    spark: SparkSession, path: str, on: tuple[str, ...] = ("position",)
) -> DataFrame:
    """Each line of JSON responses: file, line, the response's fields, and ``reason`` if it can't be
    used: no JSON object, a field of another type, no key, no status and body.

    Blank lines are no lines. Nothing is dropped: lines with a reason and lines without are all.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    corrupt = T.StructField("_corrupt", T.StringType())
    schema = T.StructType([*RESPONSES.fields, corrupt])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("line"),
        F.from_json("value", schema, options).alias("r"),
        F.try_parse_json("value").alias("json"),
    )
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(f"r.{key}").isNull()
    kind = F.schema_of_variant("json")
    reason = (
        F.when(F.col("json").isNull(), "not JSON")
        .when(~kind.startswith("OBJECT"), "not an object")
        .when(F.col("r._corrupt").isNotNull(), "a field of another type")
        .when(no_key, "no key")
        .when(F.col("r.status").isNull() & F.col("r.body").isNull(), "no status and no body")
    )
    return parsed.select("file", "line", reason.alias("reason"), "r.*").drop("_corrupt")


def accepted_lines(lines: DataFrame, on: tuple[str, ...] = ("position",)) -> DataFrame:
    """The responses to be used, as ``read_responses`` has them."""
    used = lines.where(F.col("reason").isNull())
    return usable(used.withColumn("_file", F.xxhash64("file")), on)


def rejected_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("reason").isNotNull()).select("file", "line", "reason")
