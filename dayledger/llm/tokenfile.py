"""Operator 3: token ids in a binary file format, Huffman-coded in independent blocks.

The format is a folder with two Parquet tables. ``code`` has a row per id that occurs: its code
length, from which the canonical code follows (shorter codes first, then smaller ids). ``blocks``
has a row per block, in key order: part and place of the block, the ids before it in its part, the
keys and lengths of its rows, the bits of all its ids, and the bit offset of every 256th id. Any
block can be read alone, and its checkpoints are decoded side by side from a lookup table.

Counts of ids cover all rows. Code lengths are limited (package-merge), so that the table that
decodes has a bounded size. Null texts count as empty; null keys come first; rows with equal keys
follow one another in the order of a hash of their ids. Columns besides key and text are not kept.

Texts are encoded whole, however long. An empty table gives no file and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import kept_in_worker, map_batches, map_blocks, table, text_blocks, to_driver, working_folder, written
from .words import Pieces, rows_of, words

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Ids between two checkpoints.
STEP = 256
#: Ids that are coded at once, a multiple of STEP.
PART = 1 << 15
#: Least limit of a code's length; with more than 2 ** 15 ids in use it grows by their logarithm.
CODE_BITS = 16
#: Ids that a code may have at most: lengths and ranks go through the driver.
ALPHABET = 1 << 21
#: Who works on files: what encoding has kept in a worker goes before.
_FILES = f"{__name__}.files"
#: Bytes of ids in a block, but for a single longer row.
BLOCK_BYTES = 1 << 20


# ---------------------------------------------------------------- ids


@kept_in_worker
def _pieces(path: str) -> Pieces:
    return Pieces(words(path))


def encode_ids(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer_path: str | None = None,
    end_id: int | None = END_ID,
    width: int = 4,
) -> DataFrame:
    """``key, ids``: the ids of each row as little-endian unsigned integers of ``width`` bytes."""
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    end = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        pieces = _pieces(path)
        if max(pieces.words.size - 1, end_id or 0) >= 1 << (8 * width):
            raise ValueError(f"ids do not fit into {width} bytes")
        cut = pieces.words.cut(block.column(text))
        rows = rows_of(cut, list(map(pieces.__getitem__, cut.pieces)), width)
        ids = pa.array([row + end for row in rows], pa.binary())
        return pa.record_batch({key: block.column(key), "ids": ids})

    kind = df.schema[key].dataType.simpleString()
    return map_blocks(df.select(key, text), run, f"{key} {kind}, ids binary", text)


# ---------------------------------------------------------------- the code


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code length of each symbol of positive count, by package-merge: the least total of bits
    with no code longer than ``limit``.
    """
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    n = len(weights)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError("the limit is too small")
    # Each level: the symbols and the pairs of the level below, by weight. What counts is how
    # many of the first items of a level are symbols.
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        is_symbol = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        by = np.argsort(merged, kind="stable")
        merged, is_symbol = merged[by], is_symbol[by]
        levels.append(np.concatenate([[0], np.cumsum(is_symbol)]))
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for symbols in reversed(levels):
        own = int(symbols[take])
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of ids with their lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        by = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[by].astype(np.int32), lengths[by].astype(np.int64)
        self.bits = int(self.lengths[-1]) if len(ids) else 1
        # Codes are consecutive when written with all bits: each takes 2 ** (bits - length).
        width = np.left_shift(1, self.bits - self.lengths)
        first = np.cumsum(width) - width
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code = np.zeros(size, np.uint64)
        self.length = np.zeros(size, np.int64)
        self.code[self.ids] = (first >> (self.bits - self.lengths)).astype(np.uint64)
        self.length[self.ids] = self.lengths
        # Decoding: the symbol and length for each value of the next bits.
        self.symbol_at = np.zeros(1 << self.bits, np.int32)
        self.length_at = np.ones(1 << self.bits, np.int64)
        self.symbol_at[: int(width.sum())] = np.repeat(self.ids, width)
        self.length_at[: int(width.sum())] = np.repeat(self.lengths, width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """Payload, the bit offset of each STEP-th id, the number of bits."""
        n = len(ids)
        bits = int(self.length[ids].sum())
        out = np.zeros(bits // 32 + 2)
        checkpoints, start = [], 0
        # In parts that stay in a processor's cache.
        for k in range(0, n, PART):
            part = ids[k : k + PART]
            length = self.length[part]
            end = start + np.cumsum(length)
            at = end - length
            shift = (64 - (at & 31) - length).astype(np.uint64)
            value = self.code[part] << shift
            first = start >> 5
            word = (at >> 5) - first
            # Bits of different ids never overlap, so that sums of doubles below 2 ** 32 are exact.
            high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64))
            low = np.bincount(word, (value & np.uint64(0xFFFFFFFF)).astype(np.float64))
            out[first : first + len(high)] += high
            out[first + 1 : first + 1 + len(low)] += low
            checkpoints.append(at[::STEP])
            start = int(end[-1])
        at = np.concatenate([np.empty(0, np.int64), *checkpoints])
        return out.astype(">u4").tobytes(), at, bits

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.concatenate([np.frombuffer(payload, np.uint8), np.zeros(8, np.uint8)])
        raw = raw.astype(np.uint32)
        # Four bytes from each byte on, as one number.
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.empty((STEP, len(checkpoints)), np.int32)
        at = checkpoints.astype(np.int64)
        mask, top = np.uint32((1 << self.bits) - 1), 32 - self.bits
        last = 8 * (len(window) - 1)
        for k in range(STEP):
            slot = (window[at >> 3] >> (top - (at & 7)).astype(np.uint32)) & mask
            out[k] = self.symbol_at[slot]
            at += self.length_at[slot]
            np.minimum(at, last, out=at)  # past the end in the last lane only
        return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- files


def _id_counts(rows: DataFrame, width: int) -> DataFrame:
    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        raw = b"".join(x or b"" for x in block.column("ids").to_pylist())
        counts = np.bincount(np.frombuffer(raw, f"<u{width}"))
        ids = np.flatnonzero(counts)
        n = counts[ids]
        return pa.record_batch(
            {"id": pa.array(ids, pa.int32()), "n": pa.array(n, pa.int64())}
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(run, text_blocks(batches, "ids", 16 * BLOCK_BYTES))

    counted = map_batches(rows.select("ids"), blocks, "id int, n long", _FILES)
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_token_file(
    rows: DataFrame, folder: str, key: str = "doc_id", width: int = 4
) -> None:
    """Rows ``key, ids`` (of ``width`` bytes) to the files of ``folder``, in ascending key order."""
    spark = rows.sparkSession
    found = np.array(
        [(r["id"], r["n"]) for r in to_driver(_id_counts(rows, width), ALPHABET)], np.int64
    ).reshape(-1, 2)
    found = found[np.argsort(found[:, 0])]
    limit = max(CODE_BITS, int(len(found)).bit_length() + 1)
    lengths = code_lengths(found[:, 1], limit)
    spark.createDataFrame(
        list(zip(found[:, 0].tolist(), lengths.tolist(), strict=True)), "id int, length int"
    ).coalesce(1).write.parquet(f"{folder}/code")
    ids = found[:, 0]
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, before = Code(ids, lengths), TaskContext.get().partitionId(), 0
        for number, block in enumerate(text_blocks(batches, "ids", BLOCK_BYTES)):
            each = [x or b"" for x in block.column("ids").to_pylist()]
            flat = np.frombuffer(b"".join(each), f"<u{width}")
            payload, checkpoints, bits = code.encode(flat)
            keys = block.column(key)
            yield pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([number], pa.int64()),
                    "ids_before": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(flat)], pa.int64()),
                    "bits": pa.array([bits], pa.int64()),
                    "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    "lengths": pa.array([[len(x) // width for x in each]], pa.list_(pa.int64())),
                    "checkpoints": pa.array([checkpoints.astype("<u4" if bits < 1 << 32 else "<u8").tobytes()]),
                    "payload": pa.array([payload]),
                }
            )
            before += len(flat)

    # A range of keys per task. Rows of one key, even equal ones, may fall to several tasks.
    place = (F.col(key), F.xxhash64("ids").alias("__hash"), F.monotonically_increasing_id().alias("__row"))
    by = (key, "__hash", "__row")
    placed = rows.select(*place, "ids").repartitionByRange(*by)
    ordered = placed.sortWithinPartitions(*by).select(key, "ids")
    map_batches(
        ordered,
        run,
        f"part int, block long, ids_before long, n_ids long, bits long, keys array<{kind}>, "
        "lengths array<long>, checkpoints binary, payload binary",
        _FILES,
    ).write.parquet(f"{folder}/blocks")


def read_token_file(
    spark: SparkSession, folder: str, key: str = "doc_id", digest: bool = False
) -> DataFrame:
    """``key, start, ids``: each row of the file, ``start`` being the ids of all rows before it.

    With ``digest``, ``n_tokens`` and ``ids_crc32`` (of the ids in four bytes) in place of the ids.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    code = to_driver(spark.read.parquet(f"{folder}/code"), ALPHABET)
    ids = np.array([r["id"] for r in code], np.int64)
    lengths = np.array([r["length"] for r in code], np.int64)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    # One row per part; their number is that of the tasks that wrote.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    starts = F.broadcast(parts.select("part", before.alias("part_start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = None
        for batch in batches:
            table_ = table_ or Code(ids, lengths)
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                n = one["n_ids"].as_py()
                width = "<u4" if one["bits"].as_py() < 1 << 32 else "<u8"
                checkpoints = np.frombuffer(one["checkpoints"].as_py(), width)
                raw = table_.decode(one["payload"].as_py(), checkpoints, n).astype("<i4").tobytes()
                each = np.array(one["lengths"].as_py(), np.int64)
                ends = np.cumsum(each)
                first = one["part_start"].as_py() + one["ids_before"].as_py()
                cut = [raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), each.tolist())]
                out = {
                    key: one["keys"].values,
                    "start": pa.array(first + ends - each, pa.int64()),
                }
                if digest:
                    out["n_tokens"] = pa.array(each, pa.int64())
                    out["ids_crc32"] = pa.array([zlib.crc32(x) for x in cut], pa.int64())
                else:
                    out["ids"] = pa.array(cut, pa.binary())
                yield pa.record_batch(out)

    ids_kind = "n_tokens long, ids_crc32 long" if digest else "ids binary"
    schema = f"{key} {kind}, start long, {ids_kind}"
    return map_batches(blocks.join(starts, "part"), run, schema, _FILES)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark)
    # Kept, as counting and writing both need the ids; they fit into two bytes.
    rows = written(encode_ids(table(spark, sf_dir, "documents"), width=2))
    write_token_file(rows, folder, width=2)
    return read_token_file(spark, folder, digest=True)
