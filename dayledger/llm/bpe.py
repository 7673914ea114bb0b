"""Operator 1: byte-level BPE encoding and decoding, by DuckDB's recursive queries in each task.

A text is cut at single spaces between other characters (no match of the pattern crosses them)
and each new piece by the pattern. The words found go, as rows of token and position, through one
recursive query: adjacent rows are joined with the table of merges, each word's leftmost pair of
least rank is contracted, until no word has a pair left. Decoding joins the ids with the
vocabulary and puts their bytes together by ordered aggregation.

Null texts count as empty; an empty text has no ids. Columns that the result adds replace columns
of that name. What is kept between blocks is a cache of bounded size and never changes a result.

Texts are read whole, however long; each row, repeated or not, has a row of its own. An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from .common import kept_in_worker, map_blocks, table
from .words import Cut, rows_of

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces that a worker keeps, about; of words twice as many. What comes first stays.
CACHE = 150_000
#: Words of more bytes take a heap instead of one recursion step per merge.
LONG_WORD = 1_000
#: Characters that are encoded at once: the more, the fewer words are met again as new.
BLOCK_CHARS = 2 << 20
#: Rows that one recursive query may make.
QUERY_ROWS = 500_000
#: Ids that one query decodes, but for a single longer row.
QUERY_IDS = 200_000

# A space beside other white space, or at an end.
_WHITE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_ODD = rf"^ | $| {_WHITE}|{_WHITE} "

# slot: the word's number and the token's position in one number.
_CONTRACT = """
WITH RECURSIVE step AS (
    SELECT slot, id, 0 AS round FROM start
    UNION ALL
    SELECT s.slot, CASE WHEN s.slot = b.slot THEN b.merged ELSE s.id END, s.round + 1
    FROM step s JOIN (
        -- rank and position in one number: the least is the leftmost pair of least rank
        SELECT word, (word << 20) | (min(key) & 1048575) AS slot, (min(key) >> 20)::INT AS merged,
               arg_min(next_slot, key) AS gone
        FROM (SELECT slot >> 20 AS word, (rank::BIGINT << 20) | (slot & 1048575) AS key, next_slot
              FROM (SELECT slot, lead(slot) OVER w AS next_slot,
                           (id::BIGINT << 32) | lead(id) OVER w AS pair
                    FROM step WINDOW w AS (ORDER BY slot))
              JOIN merges USING (pair)
              WHERE next_slot >> 20 = slot >> 20)
        GROUP BY word
    ) b ON s.slot >> 20 = b.word
    WHERE s.slot <> b.gone
)
SELECT slot >> 20 AS word, id
FROM step JOIN (SELECT slot >> 20 AS word, max(round) AS round FROM step GROUP BY word) last
    ON slot >> 20 = last.word AND step.round = last.round
ORDER BY slot
"""

# One thread aggregates in the order that the inner query gives.
_DECODE = """
SELECT row, unhex(string_agg(hex, '')) AS bytes
FROM (SELECT row, hex FROM ids JOIN vocabulary USING (id) ORDER BY pos) GROUP BY row
"""


class Codec:
    """One rank file in one process: the tables, and what has been seen so far."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as lines:
            self.ranks = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
            }
        self.pattern = regex.compile(pattern)
        # No match of the pattern holds a space between two other characters, but as its first.
        self.gap = regex.compile(r"(?<=\S) (?=\S)")
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.merges = dict(zip(pairs, merged, strict=True))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB"})
        for name, columns in (
            ("merges", {"pair": pa.array(pairs, pa.int64()), "rank": pa.array(merged, pa.int32())}),
            ("vocabulary", {"id": pa.array(self.ranks.values(), pa.int32()),
                            "hex": [token.hex() for token in self.ranks]}),
        ):
            self.db.register("given", pa.table(columns))
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        size = max(self.ranks.values()) + 1
        self.known = np.zeros(size, bool)
        self.known[list(self.ranks.values())] = True
        self.decimal = [str(rank) for rank in range(size)]
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    # ------------------------------------------------------------ encoding

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, int32; null counts as empty."""
        cut = self._cut(pc.fill_null(texts, ""))
        seen = self.pieces
        learnt = self._learn({piece for piece in cut.pieces if piece not in seen})
        if len(seen) < CACHE:
            seen.update(learnt)
        ids = [seen[p] if p in seen else learnt[p] for p in cut.pieces]
        return [np.frombuffer(row, np.int32) for row in rows_of(cut, ids)]

    def _cut(self, texts: pa.Array) -> Cut:
        """At single spaces between other characters; a piece but the first begins with one."""
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        coded = lists.flatten().dictionary_encode()
        pieces = [" " + p for p in coded.dictionary.to_pylist()]
        at, bounds = coded.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy()
        # First pieces have no space, and texts with other white space are cut one by one.
        firsts = lists.flatten().take(pa.array(bounds[:-1])).to_pylist()
        at[bounds[:-1]] = len(pieces) + np.arange(len(firsts))
        pieces += firsts
        if not odd.any():
            return Cut(pieces, at, bounds)
        places, ends = [], [0]
        for k, is_odd in enumerate(odd.tolist()):
            here = at[bounds[k] : bounds[k + 1]]
            if is_odd:
                first, *others = self.gap.split(texts[k].as_py())
                here = np.arange(len(pieces), len(pieces) + 1 + len(others))
                pieces += [first, *(" " + p for p in others)]
            places.append(here)
            ends.append(ends[-1] + len(here))
        return Cut(pieces, np.concatenate(places), np.array(ends))

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        found = {piece: self.pattern.findall(piece) for piece in pieces}
        ids, rows, batch = {}, 0, []
        for word in {word for words in found.values() for word in words}:
            known = self.words.get(word)
            if known is not None:
                ids[word] = known
                continue
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:  # a whole token needs no merge
                ids[word] = np.int32(rank).tobytes()
            elif len(raw) > LONG_WORD:
                ids[word] = self._contract_long(raw)
            else:
                batch.append((word, raw))
                rows += len(raw) ** 2 // 2
                if rows > QUERY_ROWS:
                    ids.update(self._contract(batch))
                    rows, batch = 0, []
        if batch:
            ids.update(self._contract(batch))
        if len(self.words) < 2 * CACHE:
            self.words.update(ids)
        return {piece: b"".join([ids[word] for word in words]) for piece, words in found.items()}

    def _contract(self, batch: list[tuple[str, bytes]]) -> dict[str, bytes]:
        lengths = np.array([len(raw) for _, raw in batch])
        flat = np.frombuffer(b"".join([raw for _, raw in batch]), np.uint8)
        pos = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        start = pa.table(
            {
                "slot": (np.repeat(np.arange(len(batch)), lengths) << 20) | pos,
                "id": self.byte_ids[flat],
            }
        )
        self.db.register("start", start)
        ended = self.db.sql(_CONTRACT).to_arrow_table()
        self.db.unregister("start")
        ids = ended["id"].to_numpy().astype(np.int32).tobytes()
        ends = np.cumsum(np.bincount(ended["word"].to_numpy(), minlength=len(batch))) * 4
        found, at = {}, 0
        for (word, _), end in zip(batch, ends.tolist(), strict=True):
            found[word] = ids[at:end]
            at = end
        return found

    def _contract_long(self, raw: bytes) -> bytes:
        """The same contraction with a heap, for a word as long as a text."""
        ids = [int(self.byte_ids[b]) for b in raw]
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [
            (rank, k, ids[k], ids[k + 1])
            for k in range(n - 1)
            if (rank := self.merges.get(ids[k] << 32 | ids[k + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            other = after[k]
            if ids[k] != left or other < 0 or ids[other] != right:
                continue
            ids[k], ids[other] = rank, -1
            after[k] = after[other]
            if after[k] >= 0:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0:
                    found = self.merges.get(ids[a] << 32 | ids[b])
                    if found is not None:
                        heapq.heappush(heap, (found, a, ids[a], ids[b]))
        return np.array([i for i in ids if i >= 0], np.int32).tobytes()

    # ------------------------------------------------------------ decoding

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each row of ids; an id outside the vocabulary raises."""
        out: list[bytes] = []
        held, size = [], 0
        for row in ids:
            if held and size + len(row) > QUERY_IDS:
                out += self._decode(held)
                held, size = [], 0
            held.append(row)
            size += len(row)
        return out + self._decode(held)

    def _decode(self, ids: list[np.ndarray]) -> list[bytes]:
        flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
        if len(flat) and not (
            0 <= flat.min() and flat.max() < len(self.known) and self.known[flat].all()
        ):
            raise ValueError("an id is not in the vocabulary")
        rows = {
            "row": np.repeat(np.arange(len(ids), dtype=np.int32), [len(row) for row in ids]),
            "pos": np.arange(len(flat), dtype=np.int32),
            "id": flat,
        }
        self.db.register("ids", pa.table(rows))
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("ids")
        out = [b""] * len(ids)
        for k, raw in zip(found["row"].to_pylist(), found["bytes"].to_pylist(), strict=True):
            out[k] = raw
        return out

    def decimals(self, row: np.ndarray) -> str:
        return " ".join(map(self.decimal.__getitem__, row.tolist()))


@kept_in_worker
def codec(ranks_path: str, pattern: str) -> Codec:
    """One per process."""
    return Codec(ranks_path, pattern)


def _options(ranks_path: str | None, pattern: str | None) -> tuple[str, str]:
    return ranks_path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *rows])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _with(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """Without a column of that name, and the schema that has it last."""
    df = df.drop(name)
    return df, T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(
    df: DataFrame,
    text: str = "text",
    ids: str = "token_ids",
    ranks_path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Adds ``ids``, an array of int for each row; all other columns stay."""
    options = _options(ranks_path, pattern)
    df, schema = _with(df, ids, T.ArrayType(T.IntegerType(), False))

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        return block.append_column(ids, _lists(codec(*options).encode(block.column(text))))

    return map_blocks(df, run, schema, text, BLOCK_CHARS)


def decode(
    df: DataFrame,
    ids: str = "token_ids",
    raw: str = "decoded",
    ranks_path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Adds ``raw``, the bytes of each row's ids; null ids count as none, unknown ids raise."""
    options = _options(ranks_path, pattern)
    df, schema = _with(df, raw, T.BinaryType())

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.array(row or [], np.int32) for row in block.column(ids).to_pylist()]
        found = codec(*options).decode(rows)
        return block.append_column(raw, pa.array(found, pa.binary()))

    return map_blocks(df, run, schema, None, 64 * 500)


def round_trip(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks_path: str | None = None,
    pattern: str | None = None,
    ids: str | None = None,
) -> DataFrame:
    """Encodes and decodes in one pass: ``key, n_tokens, ids_sha256, decoded_sha256``.

    With ``ids`` the ids themselves follow, in an array of that name.
    """
    options = _options(ranks_path, pattern)
    kind = df.schema[key].dataType.simpleString()

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(*options)
        rows = own.encode(block.column(text))
        back = own.decode(rows)
        out = pa.record_batch(
            {
                key: block.column(key),
                "n_tokens": pa.array([len(row) for row in rows], pa.int64()),
                "ids_sha256": [
                    hashlib.sha256(own.decimals(row).encode()).hexdigest() for row in rows
                ],
                "decoded_sha256": [hashlib.sha256(raw).hexdigest() for raw in back],
            }
        )
        # What one block has left behind would lie beside the next one.
        pa.default_memory_pool().release_unused()
        return out.append_column(ids, _lists(rows)) if ids else out

    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += f", {ids} array<int>" if ids else ""
    return map_blocks(df.select(key, text), run, schema, text, BLOCK_CHARS)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
