"""Operator 6: token counts, with whole tokens counted directly.

First it is proved, by asking the library once per worker, which strings of the vocabulary encode
alone as one token. A text is cut into pre-tokens; those among the proved strings count one each,
without any merging, and only the rest is merged by the library, each distinct one once.

Null and empty texts have 0 bytes and 0 tokens. Columns besides the key and the text are dropped.

Texts are counted whole, however long; repeated rows are counted each. An empty table gives an empty
result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import kept_in_worker, map_blocks, table
from .words import PARTS, PIECES, Words, byte_letters, words

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048


def _plain(token: str) -> str:
    """What a token at a word's end stands for; empty if that is no text."""
    if not token.endswith("</w>"):
        return ""
    byte_of = {chr(letter): byte for byte, letter in byte_letters().items()}
    try:
        return bytes(byte_of[c] for c in token.removesuffix("</w>")).decode()
    except (KeyError, UnicodeDecodeError):
        return ""


@cache
def single_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings, as pre-tokens, that encode alone as exactly one token.

    Empty where pre-tokens can't be told from outside the library.
    """
    own = words(path)
    if own.pre_tokens is None:
        return frozenset()
    strings = {s for token in own.tokenizer.get_vocab() if (s := _plain(token))}
    return frozenset(s for s in strings if own.parts(s) == [s] and len(own.encode(s)) == 1)


class _Merged(dict):
    """Tokens of the pre-tokens that are not one token."""

    def __init__(self, words_: Words) -> None:
        self.words = words_

    def __missing__(self, part: str) -> int:
        n = len(self.words.merge(part))
        if len(self) < PARTS:
            self[part] = n
        return n


class Counts(dict):
    """Tokens of pieces; at first those that are proved to be one."""

    def __init__(self, path: str) -> None:
        self.words = words(path)
        self.single = single_tokens(path)
        super().__init__(dict.fromkeys(self.single, 1) | {"": 0})
        self.merged = _Merged(self.words)

    def __missing__(self, piece: str) -> int:
        parts = self.words.parts(piece)
        if parts is None:
            n = len(self.words.encode(piece))
        else:
            n = sum([1 if part in self.single else self.merged[part] for part in parts])
        if len(self) < PIECES and self.words.pre_tokens is not None:
            self[piece] = n
        return n


@kept_in_worker
def counts(path: str) -> Counts:
    return Counts(path)


def count_tokens(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer_path: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for each row, as the library counts."""
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    kind = df.schema[key].dataType.simpleString()

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column(text)
        own = counts(path)
        cut = own.words.cut(texts)
        each = np.fromiter(map(own.__getitem__, cut.pieces), np.int64, len(cut.pieces))
        ends = np.concatenate([[0], np.cumsum(each[cut.at])])
        n = pa.array(np.diff(ends[cut.bounds]), pa.int64())
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return pa.record_batch(
            {key: block.column(key), "n_bytes": size, "n_tokens": n,
             "over_limit": pc.greater(n, limit)}
        )

    schema = f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_blocks(df.select(key, text), run, schema, text)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
