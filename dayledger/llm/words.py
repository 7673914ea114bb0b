"""A tokenizer file in one process, asked as rarely as possible.

Where the file's own settings show that no token crosses white space (its pre-tokenizer keeps
only matches without any), a text is cut at spaces and line ends, and what a piece encodes to is
kept. A piece of plain Latin characters, which normalisation only lower-cases, is cut further into
pre-tokens, which the library's model merges. Everything else goes to the library as it is.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import kept_in_worker

#: What a worker keeps at most: pieces and pre-tokens. What comes first stays.
PIECES, PARTS = 300_000, 200_000

#: A pre-token when after letters and at the end.
_MARKS = frozenset(".,;:!?")
_SPACE = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}


class Cut(NamedTuple):
    """Different pieces, the piece at each place, and where each text's places begin."""

    pieces: list[str]
    at: np.ndarray
    bounds: np.ndarray


class Words:
    def __init__(self, path: str) -> None:
        # The work is spread by Spark; threads of the library would only get in its way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pre_tokens = None
        self.special = ""
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = model.encode
            self.size = model.vocab_size()
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.encode = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.pre_tokens = _pattern(settings)
        # A piece that holds the first characters of all special tokens may hold one of them.
        self.special = os.path.commonprefix([t["content"] for t in settings["added_tokens"]])

    def cut(self, texts: pa.Array) -> Cut:
        """Pieces that encode on their own; empty ones have no tokens. Null counts as empty."""
        texts = pc.fill_null(texts, "")
        if self.pre_tokens is None:
            return Cut(texts.to_pylist(), np.arange(len(texts)), np.arange(len(texts) + 1))
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        return Cut(
            coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy()
        )

    def parts(self, piece: str) -> list[str] | None:
        """The pre-tokens of a plain piece; None for any other."""
        if self.pre_tokens is None or not (piece.isascii() or max(piece) < "ɐ"):
            return None
        if "İ" in piece:
            return None
        if piece.isalpha():
            return [piece.lower()]
        if piece[-1:] in _MARKS and piece[:-1].isalpha():
            return [piece[:-1].lower(), piece[-1]]
        if not piece.isprintable() or self.special in piece:
            return None
        return self.pre_tokens.findall(piece.lower())

    def merge(self, part: str) -> list[int]:
        """Ids of one pre-token of a plain piece."""
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(byte_letters())
        return [token.id for token in self.model.tokenize(part)]


@cache
def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


def _pattern(settings: dict) -> regex.Pattern | None:
    """The pre-token pattern, if pieces between white space are independent of each other."""
    normalizer = settings["normalizer"] or {}
    steps = normalizer.get("normalizers", [normalizer])
    known = [{"type": "NFC"}, _SPACE, {"type": "Lowercase"}]
    splits = (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != known or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return None
    split, rest = splits
    drops = split["behavior"] == "Removed" and split["invert"]
    plain = not rest["add_prefix_space"] and not rest["use_regex"]
    special = [t["content"] for t in settings["added_tokens"]]
    free = all(
        t["content"].split() == [t["content"]] and not (t["lstrip"] or t["rstrip"] or t["normalized"])
        for t in settings["added_tokens"]
    )
    pattern = regex.compile(split["pattern"]["Regex"])
    known = drops and plain and free and not pattern.search(" \t\r\n")
    return pattern if known and os.path.commonprefix(special) else None


class Parts(dict):
    """Ids of pre-tokens, as bytes."""

    def __init__(self, words: Words) -> None:
        self.words = words

    def __missing__(self, part: str) -> bytes:
        ids = array("i", self.words.merge(part)).tobytes()
        if len(self) < PARTS:
            self[part] = ids
        return ids


class Pieces(dict):
    """Ids of pieces, as bytes."""

    def __init__(self, words: Words) -> None:
        super().__init__({"": b""})
        self.words = words
        self.parts = Parts(words)

    def __missing__(self, piece: str) -> bytes:
        parts = self.words.parts(piece)
        if parts is None:
            ids = array("i", self.words.encode(piece)).tobytes()
        elif len(parts) == 1:
            ids = self.parts[parts[0]]
        else:
            ids = b"".join([self.parts[part] for part in parts])
        if len(self) < PIECES and self.words.pre_tokens is not None:
            self[piece] = ids
        return ids


def rows_of(cut: Cut, ids: list[bytes], width: int = 4) -> list[bytes]:
    """Each text's ids in ``width`` bytes, from those of the different pieces."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.int32).astype(f"<u{width}")
    starts = np.cumsum(lengths) - lengths
    here = lengths[cut.at]
    ends = np.concatenate([[0], np.cumsum(here)])
    places = np.repeat(starts[cut.at] - ends[:-1], here) + np.arange(ends[-1])
    raw = flat[places].tobytes()
    bounds = (ends[cut.bounds] * width).tolist()
    return [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


@kept_in_worker
def words(path: str) -> Words:
    return Words(path)
