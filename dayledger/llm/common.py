"""What the operators share: text blocks of bounded size, tables in the shared folder, components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dayledger.session import working_folder, written
from dayledger.sinks.folders import discard_folder

_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of one Arrow batch sent to Python, unless the session says otherwise.
BATCH_BYTES = 8 << 20
#: Characters that one call of a block function sees at most, but for a single longer text.
BLOCK_CHARS = 4 << 20

__all__ = [
    "BLOCK_CHARS", "claim", "connected_components", "kept_in_worker", "lower_ascii", "map_batches", "map_blocks", "table", "text_blocks",
    "to_driver", "without", "working_folder", "written",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_blocks(
    batches: Iterable[pa.RecordBatch], text: str | None, chars: int = BLOCK_CHARS
) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut so that their texts hold about ``chars`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        lengths = (
            pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            if text
            else [64] * batch.num_rows
        )
        for i, n in enumerate(lengths):
            if size and size + n > chars:
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield _joined(held)
                held, size, at = [], 0, i
            size += n + 16
        if batch.num_rows > at:
            held.append(batch.slice(at))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def map_blocks(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | T.StructType,
    text: str | None = "text",
    chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``mapInArrow`` over blocks of bounded size, whatever the session's batch length is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, text, chars):
            yield function(block)

    return map_batches(df, run, schema, function.__module__)


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
    owner: str | None = None,
) -> DataFrame:
    """``mapInArrow`` with batches of bounded size, unless the session says otherwise."""
    owner = owner or function.__module__
    spark = df.sparkSession
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        yield from function(batches)

    return df.mapInArrow(run, schema)


_caches: list = []
_owner = [""]


def kept_in_worker(make: Callable) -> Callable:
    """``functools.cache`` whose values a worker drops when it works for another operator.

    A worker process outlives its tasks; without this, what one stage of a pipeline has kept
    would lie beside what the next one keeps.
    """
    cached = cache(make)
    _caches.append((make.__module__, cached))
    return cached


def claim(owner: str) -> None:
    """From now on this worker works for the module ``owner``."""
    if owner == _owner[0]:
        return
    _owner[0] = owner
    for module, cached in _caches:
        if module != owner:
            cached.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def to_driver(df: DataFrame, bound: int) -> list:
    """Rows of a table that is proven to hold at most ``bound`` rows."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} rows")
    return rows


def _round(edges: DataFrame) -> DataFrame:
    """Large star, then small star: every edge moves towards the smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # Large star: the larger neighbours of u are linked to the least of u and its neighbours.
    m = F.least("u", "m")
    large = (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), m.alias("v"))
        .distinct()
    )
    # Small star: u and its smaller neighbours are linked to the least of them.
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    linked = large.join(least, "u")
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _written_to(df: DataFrame) -> tuple[DataFrame, str]:
    folder = working_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(u, v)`` pairs to ``(node, component)``, the component being its smallest node.

    Alternating large and small stars; each round is written to the shared folder, so a lost
    executor costs a file read. Self links are dropped: a node without another link has no row.
    Raises when the rounds do not suffice, which takes paths of about 2 ** most_rounds nodes.
    """
    spark = edges.sparkSession
    edges, folder = _written_to(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    for _ in range(most_rounds):
        edges, newer = _written_to(_round(edges))
        discard_folder(spark, folder)  # all of it is in the newer one
        folder = newer
        # Stars only, and the same stars again: the number of edges and their sum stay.
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = now
    raise ValueError(f"components still change after {most_rounds} rounds")


def lower_ascii(text: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bits of the filter that ``without`` broadcasts: 8 MB, however many rows are to go.
FILTER_BITS = 1 << 26


def without(rows: DataFrame, gone: DataFrame, on: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose ``on`` columns are not in ``gone``; null equals null.

    A filter of fixed size, broadcast, tells for most rows that they stay, and these are not
    shuffled. Only rows that it can't tell apart from those to go are joined by the columns
    themselves, so the plan is the same at every size and the result is exact.
    """
    gone = written(gone.select(*on).distinct())
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    maps = gone.select(
        F.bitmap_bucket_number(place).alias("__bucket"), F.bitmap_bit_position(place).alias("__at")
    )
    maps = maps.groupBy("__bucket").agg(F.bitmap_construct_agg("__at").alias("__map"))
    given = rows.withColumn("__place", place)
    marked = given.join(
        F.broadcast(maps), F.bitmap_bucket_number(F.col("__place")) == F.col("__bucket"), "left"
    )
    at = F.bitmap_bit_position(F.col("__place"))
    byte = F.expr("substring(__map, cast(bitmap_bit_position(__place) div 8 as int) + 1, 1)")
    bit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(
        F.pow(F.lit(2), F.pmod(at, F.lit(8))).cast("int")
    )
    unsure = F.coalesce(bit != 0, F.lit(False))
    names = {c: f"__gone_{k}" for k, c in enumerate(on)}
    same = F.lit(True)
    for c, name in names.items():
        same = same & F.col(c).eqNullSafe(F.col(name))
    stay = marked.where(unsure).select(*rows.columns)
    stay = stay.join(gone.withColumnsRenamed(names), same, "left_anti")
    return marked.where(~unsure).select(*rows.columns).union(stay)
