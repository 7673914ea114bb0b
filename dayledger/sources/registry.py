"""Station registry: one JSON array, or files with one entry per line; its order numbers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayledger.operators.numbering import numbered_lines
from dayledger.schemas import BATCH_SIZE, LAST_BATCH

# Keys that each entry must have.
ENTRY_KEYS = ("station_name", "lat", "lon")


def parse_registry(documents: DataFrame, text: str = "value") -> DataFrame:
    """One row per array element: the other columns, position, station_name, lat, lon.

    Coordinates may be numbers or numeric text; anything else becomes NULL. A missing
    key fails the job, but only for stations that are still wanted when it is evaluated:
    the check is in the projected name, above any filter on the position.
    """
    array = F.coalesce(
        F.from_json(text, "array<variant>", {"mode": "FAILFAST"}),
        F.raise_error(F.lit("empty registry document")).cast("array<variant>"),
    )
    return _stations(
        documents.select(
            *[c for c in documents.columns if c != text],
            F.posexplode(array).alias("position", "entry"),
        )
    )


def _stations(entries: DataFrame) -> DataFrame:
    """The variant ``entry`` as station_name, lat, lon."""

    def part(key: str, kind: str) -> Column:
        return F.try_variant_get("entry", f"$.{key}", kind)

    complete = F.lit(True)
    for key in ENTRY_KEYS:
        complete = complete & part(key, "variant").isNotNull()
    return entries.select(
        *[c for c in entries.columns if c != "entry"],
        F.when(complete, part("station_name", "string"))
        .otherwise(F.raise_error(F.lit("registry entry without station_name, lat or lon")))
        .alias("station_name"),
        part("lat", "double").alias("lat"),
        part("lon", "double").alias("lon"),
    )


def read_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A registry document; with ``lines``, files that have one entry per line.

    A document is one value, so one task parses it. Lines are read by many tasks, which number
    them without a window: position 0 is the first line of the first file, by path. Blank lines
    do not count. All functions that take stations also accept a table with a ``position``.
    """
    if not lines:
        return parse_registry(spark.read.text(path, wholetext=True))
    text = spark.read.text(path).where(F.trim("value") != "")
    numbered = numbered_lines(text)
    # Unlike in a document, the other lines are known to be entries of their own.
    entry = F.from_json("value", "entry variant", {"mode": "FAILFAST", "singleVariantColumn": "entry"})
    return _stations(
        numbered.select(F.col("position").cast("int").alias("position"), entry["entry"].alias("entry"))
    )


def with_batch(
    stations: DataFrame, size: int = BATCH_SIZE, last: int = LAST_BATCH, position: str = "position"
) -> DataFrame:
    """Number of the station's batch; the last batch is open-ended."""
    batch = F.expr(f"cast(least({position} div {size}, {last}) as int)")
    return stations.withColumn("batch", batch)


def in_batch(
    stations: DataFrame,
    batch: int,
    size: int = BATCH_SIZE,
    last: int = LAST_BATCH,
    position: str = "position",
) -> DataFrame:
    """Stations of one batch, as a plain range on the position."""
    if not 0 <= batch <= last:
        raise ValueError(f"no batch {batch}: batches run from 0 to {last}")
    wanted = F.col(position) >= batch * size
    if batch < last:
        wanted = wanted & (F.col(position) < (batch + 1) * size)
    return stations.where(wanted)


def batch_sizes(
    stations: DataFrame, size: int = BATCH_SIZE, last: int = LAST_BATCH, position: str = "position"
) -> DataFrame:
    """One row: stations in all and in each batch, empty batches as 0."""
    numbered = with_batch(stations, size, last, position)
    return numbered.agg(
        F.count(F.lit(1)).alias("stations"),
        *[F.count_if(F.col("batch") == b).alias(f"batch_{b}") for b in range(last + 1)],
    )
