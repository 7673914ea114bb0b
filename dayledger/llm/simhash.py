"""Operator 7: SimHash near-duplicates, found by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into three segments of 22, 21 and 21 bits. Each segment, padded to
23, is a word of the binary Golay code, whose spheres of radius 3 fill the space; the code's words
within 4 of a segment are one or six, and two segments that differ in at most two bits have one of
them in common (the word nearest to what lies between them). Two fingerprints that differ in at
most two bits have a segment without errors, so that the keys "segment i as it is, code word of
the next segment" find every such pair; candidates are then verified.

Equal fingerprints are one row from the start. Keys that more than ``CROWD`` different fingerprints
share are not paired at all: a fingerprint and its 64 neighbours at one bit are looked up instead,
as two fingerprints that meet at the same neighbour differ in at most two bits, and the other way
round. So the work grows with the number of fingerprints, never with the square of a group.

Null texts count as empty: no words, fingerprint zero, linked like any other. Rows with a null key
take part; a component's id is its smallest key that is not null, and null if there is none.

Texts are read whole, however long; repeated rows have a row each, in the same component. An empty
table gives an empty result. Only the key, the text and columns asked for are read.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import connected_components, map_blocks, table, written

SHINGLE = 3
DISTANCE = 2
SEED = 42
SEGMENTS = (22, 21, 21)
#: Fingerprints that share a key and are compared pair by pair.
CROWD = 24
#: The Golay code's generator polynomial, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed, as Spark's long holds it."""
    # bytes.lower and bytes.split know A-Z and the six ASCII spaces only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)
        ]
    flat = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(flat), 1 << 16):
        set_bits += np.unpackbits(flat[k : k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes)).view(">i8")[0])


def fingerprints(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, the columns to carry and ``fingerprint`` (long), a row for each row."""
    own = list(dict.fromkeys((key, *carry)))

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle) for t in block.column(text).to_pylist()]
        return pa.record_batch(
            {c: block.column(c) for c in own} | {"fingerprint": pa.array(found, pa.int64())}
        )

    given = df.select(*dict.fromkeys((*own, text)))
    out = df.select(*own, F.lit(0).cast("long").alias("fingerprint")).schema
    return map_blocks(given, run, out, text)


# ---------------------------------------------------------------- Golay code


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of 23-bit polynomials by the generator: eleven bits."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GENERATOR << (bit - 11)), words)
    return words


@cache
def _nearby() -> np.ndarray:
    """For each remainder the one or six errors of weight 4 at most that leave it, else -1."""
    out = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            left = int(_remainder(np.array([error]))[0])
            out[left, filled[left]] = error
            filled[left] += 1
    return out


def code_words(segments: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the code words within 4 of each 23-bit word, or -1; six columns."""
    errors = _nearby()[_remainder(segments)]
    return np.where(errors < 0, -1, (segments[:, None] ^ errors) >> 11)


def fuzzy_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: any two fingerprints that differ in two bits share a key."""
    values = values.astype(np.int64).view(np.uint64)
    cuts, at = [], 64
    for width in SEGMENTS:
        at -= width
        cuts.append(((values >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
    rows, keys = [], []
    for i, exact in enumerate(cuts):
        words = code_words(cuts[(i + 1) % len(cuts)])
        row, column = np.nonzero(words >= 0)
        rows.append(row)
        keys.append((i << 36) | (exact[row] << 12) | words[row, column])
    return np.concatenate(rows), np.concatenate(keys)


# ---------------------------------------------------------------- links


def _keyed(values: DataFrame) -> DataFrame:
    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        given = block.column("fingerprint").to_numpy()
        rows, keys = fuzzy_keys(given)
        return pa.record_batch({"key": pa.array(keys), "fingerprint": pa.array(given[rows])})

    return map_blocks(values, run, "key long, fingerprint long", None)


def links(values: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """``(u, v)``: pairs of different fingerprints, enough of them to connect all that are linked.

    ``values`` holds each fingerprint once, in a column of that name.
    """
    if not 0 <= distance <= 2:
        raise ValueError("the keys find up to two differing bits")
    keyed = _keyed(values)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    few = keyed.join(sizes.where(F.col("n").between(2, crowd)), "key")
    a, b = few.select("key", F.col("fingerprint").alias("u")), few.select(
        "key", F.col("fingerprint").alias("v")
    )
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    pairs = a.join(b, "key").where((F.col("u") < F.col("v")) & near).select("u", "v")
    many = keyed.join(sizes.where(F.col("n") > crowd), "key").select("fingerprint").distinct()
    return pairs.union(_meetings(many, distance)).distinct()


def _meetings(values: DataFrame, distance: int) -> DataFrame:
    """Links each fingerprint with the least of those that meet it at a neighbour."""
    value = F.col("fingerprint")
    one_bit = [value.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)]
    # At distance 1 only those count that are neighbours themselves.
    if distance < 2:
        at = F.explode(F.array(*(one_bit if distance else []), value))
        own = values.select(value.alias("u"), at.alias("fingerprint"))
        return own.join(values, "fingerprint").select("u", F.col("fingerprint").alias("v")).where(
            F.col("u") != F.col("v")
        )
    meeting = values.select(value.alias("u"), F.explode(F.array(value, *one_bit)).alias("place"))
    least = meeting.groupBy("place").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("n"))
    return (
        meeting.join(least.where(F.col("n") > 1), "place")
        .where(F.col("u") != F.col("v"))
        .select("u", "v")
    )


def groups(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    crowd: int = CROWD,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, the columns to carry, ``fingerprint, component, component_id``, a row for each row.

    ``component`` (the smallest fingerprint) tells groups apart whose ``component_id`` is the same,
    as rows with equal keys may be in several.
    """
    marked = written(fingerprints(df, key, text, shingle, carry))
    values = written(marked.groupBy("fingerprint").agg(F.min(key).alias("least")))
    found = connected_components(links(values.select("fingerprint"), distance, crowd))
    joined = values.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    group = F.coalesce("component", "fingerprint").alias("component")
    grouped = joined.select("fingerprint", "least", group)
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_value = written(
        grouped.join(ids, "component").select("fingerprint", "component", "component_id")
    )
    # One value may hold a third of the rows; adaptive execution splits it.
    return marked.join(by_value, "fingerprint").select(
        *dict.fromkeys((key, *carry)), "fingerprint", "component", "component_id"
    )


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    crowd: int = CROWD,
) -> DataFrame:
    """``key, fingerprint`` (hex) and ``component_id``, a row for each row."""
    return groups(df, key, text, shingle, distance, crowd).select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
