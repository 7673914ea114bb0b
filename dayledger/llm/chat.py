"""Operator 11: chat formatting, proved by a round trip through the template's own grammar.

    conversation = turn*
    turn = "[INST] " text " [/INST]"                    user
         | "[SYS] " text " [/SYS]"                      system
         | "[BOT] " text "</s>"                         assistant; its text is under the loss mask
         | "[ROLE]" role "[/ROLE] " text "[/TURN]"      any other role

A mark inside a text or a role would be read as the template's own. With one backslash or more
after its first character it is text instead, and reading takes one backslash away. A block of
turns is first rendered as it is and parsed again; where the parser does not give back the source,
each turn is escaped by itself, first the bare marks, then also those that have backslashes already,
until it does; and the block as a whole is rendered and parsed again. So texts without conflicts
stay untouched, and nothing is published that has not been read back.

Rows are rendered where they lie. Then a conversation's segments meet in the order of their turns:
they are sorted, not gathered, and stream through a task that joins them to parts of bounded size,
so a conversation with a third of all rows is held nowhere; only a digest of a whole conversation,
which is sequential by nature, makes one task read all of it.

Rows are ordered by turn, null turns first; rows with equal turns by their segment, and repeated rows
are turns of their own. A null text or role counts as empty. A null conversation id is a conversation
like any other. Very long texts are a part of their own. An empty table gives an empty result.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import BLOCK_CHARS, map_batches, map_blocks, table

# What opens and closes a turn of each role. Their first characters occur nowhere
# else in a mark, so no two marks overlap.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[BOT] ", "</s>")}
OTHER = ("[ROLE]", "[/ROLE] ", "[/TURN]")
LEARNED = "assistant"

_FAMILY = r"\[\\*/?(?:INST|SYS|BOT|ROLE|TURN)\]|<\\*/?s>"
_ANY = re.compile(_FAMILY)
_ESCAPED = re.compile(_FAMILY.replace(r"\\*", r"\\+"))
_BARE = re.compile(_FAMILY.replace(r"\\*", ""))
_ROLES = {opening: (role, closing) for role, (opening, closing) in MARKS.items()}
_OPENING = re.compile("|".join(map(re.escape, [*_ROLES, OTHER[0]])))

#: Characters of a part of a formatted conversation; a longer turn is a part of its own.
PART_CHARS = 1 << 20


class TemplateError(ValueError):
    """A text that the grammar does not produce."""


class Turn(NamedTuple):
    role: str
    text: str
    #: Where the text stands in what was parsed, as it is escaped there.
    start: int = 0
    end: int = 0


# ---------------------------------------------------------------- grammar


def _plain(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _escaped(text: str, level: int) -> str:
    """Level 0: as it is; 1: bare marks; 2: also those with backslashes."""
    if level == 0:
        return text
    return (_BARE if level == 1 else _ANY).sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def _until(formatted: str, at: int, closing: str) -> tuple[int, int]:
    """Where the text that begins here ends, and where its closing mark does."""
    mark = _BARE.search(formatted, at)
    if mark is None:
        raise TemplateError(f"no mark after {at}")
    end = mark.start() - len(closing) + len(closing.lstrip())
    after = end + len(closing)
    if end < at or formatted[end:after] != closing:
        raise TemplateError(f"{mark[0]} at {mark.start()} where {closing} should be")
    return end, after


def parse(formatted: str) -> Iterator[Turn]:
    """The turns of a formatted conversation, texts without their escapes."""
    at = 0
    while at < len(formatted):
        opening = _OPENING.match(formatted, at)
        if opening is None:
            raise TemplateError(f"no turn begins at {at}")
        at = opening.end()
        if opening[0] in _ROLES:
            role, closing = _ROLES[opening[0]]
        else:
            end, after = _until(formatted, at, OTHER[1])
            role, closing, at = _plain(formatted[at:end]), OTHER[2], after
        end, after = _until(formatted, at, closing)
        yield Turn(role, _plain(formatted[at:end]), at, end)
        at = after


def _segment(role: str, text: str, level: int) -> str:
    text = _escaped(text, level)
    if role in MARKS:
        opening, closing = MARKS[role]
        return f"{opening}{text}{closing}"
    return f"{OTHER[0]}{_escaped(role, level)}{OTHER[1]}{text}{OTHER[2]}"


def _returns(formatted: str, turns: list[tuple[str, str]]) -> bool:
    try:
        return [turn[:2] for turn in parse(formatted)] == turns
    except TemplateError:
        return False


def render(turns: list[tuple[str, str]]) -> list[str]:
    """A segment for each (role, text), escaped no more than the round trip needs."""
    levels = [0] * len(turns)
    segments = [_segment(*turn, 0) for turn in turns]
    if _returns("".join(segments), turns):
        return segments
    for i, turn in enumerate(turns):
        while not _returns(segments[i], [turn]):
            if levels[i] == 2:
                raise TemplateError("a turn does not come back")
            levels[i] += 1
            segments[i] = _segment(*turn, levels[i])
    if not _returns("".join(segments), turns):
        raise TemplateError("turns come back one by one, but not together")
    return segments


# ---------------------------------------------------------------- tables


def segments(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, turn, segment``: each row's turn as it stands in its formatted conversation."""

    def run(block: pa.RecordBatch) -> pa.RecordBatch:
        given = [
            (r or "", t or "")
            for r, t in zip(
                block.column("role").to_pylist(), block.column("text").to_pylist(), strict=True
            )
        ]
        return pa.record_batch(
            {
                "conv": block.column("conv"),
                "turn": block.column("turn"),
                "segment": pa.array(render(given), pa.string()),
            }
        )

    given = df.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"),
    )
    return map_blocks(given, run, "conv long, turn long, segment string")


_PARTS = "conv long, part int, formatted string, loss array<struct<start: int, end: int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _parts(batches: Iterable[pa.RecordBatch], part_chars: int) -> Iterator[pa.RecordBatch]:
    """Segments in order to parts in order; holds one part."""
    rows: list[tuple] = []
    held: list[str] = []
    size, now, number = 0, None, 0

    def close() -> None:
        nonlocal held, size, number
        if held:
            formatted = "".join(held)
            loss = [
                {"start": t.start, "end": t.end} for t in parse(formatted) if t.role == LEARNED
            ]
            rows.append((now, number, formatted, loss))
            held, size, number = [], 0, number + 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int32(), pa.string(), _LOSS)
        names = ("conv", "part", "formatted", "loss")
        rows.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    waiting = 0
    for given in batches:
        for conv, segment in zip(
            given.column("conv").to_pylist(), given.column("segment").to_pylist(), strict=True
        ):
            if conv != now:
                close()
                now, number = conv, 0
            if held and size + len(segment) > part_chars:
                close()
            held.append(segment)
            size += len(segment)
            waiting += len(segment)
            if waiting > BLOCK_CHARS and rows:
                yield batch()
                waiting = size
    close()
    if rows:
        yield batch()


def format_conversations(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """``conv, part, formatted, loss``: conversations as text, in parts of whole turns.

    ``part`` counts from 0; parts put together in its order are the conversation. ``loss`` has the
    spans of ``formatted`` (in code points, end exclusive) that are to be learned. A
    conversation's parts lie behind one another in one partition.
    """
    rendered = segments(df, conv, turn, role, text)
    # Ties go by the segment, which begins with the role; the null id is dealt out like any other.
    ordered = rendered.repartition("conv").sortWithinPartitions("conv", "turn", "segment")
    return map_batches(ordered.select("conv", "segment"), lambda b: _parts(b, part_chars), _PARTS)


class _Digest:
    """Of one conversation, fed part by part."""

    def __init__(self, conv: int | None) -> None:
        self.conv = conv
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, loss: list[dict]) -> None:
        self.formatted_chars += len(formatted)
        for turn in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
        for span in loss:
            learned = _plain(formatted[span["start"] : span["end"]])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted_chars,
        }


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted text says: turns, and the text under the loss mask, per conversation.

    The parts of a conversation must lie in order in one partition, as ``format_conversations``
    leaves them; ``in_order`` brings stored ones there.
    """

    def run(batches):
        digest = None
        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if digest is None or digest.conv != row["conv"] or row["part"] == 0:
                    if digest is not None:
                        done.append(digest.row())
                    digest = _Digest(row["conv"])
                digest.add(row["formatted"], row["loss"])
            if len(done) > 10_000:
                yield pa.RecordBatch.from_pylist(done, schema=_DIGESTS)
                done = []
        if digest is not None:
            done.append(digest.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGESTS)

    kinds = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return map_batches(parts, run, kinds)


def in_order(parts: DataFrame) -> DataFrame:
    """Stored parts, each conversation in one partition and in order."""
    return parts.repartition("conv").sortWithinPartitions("conv", "part")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
        "conv_id long, turn long, role string, text string",
    )
    return read_back(format_conversations(given.union(more)))


_KNOWN = " ".join(
    f"WHEN '{role}' THEN '{opening}' || e.text || '{closing}'"
    for role, (opening, closing) in MARKS.items()
)
#: A text that holds a mark with backslashes has all its marks escaped, any other its bare ones:
#: either way each gets one backslash.
OP11_SQL = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                     (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
    SELECT *, regexp_replace(text, '([\\[<])(\\\\*/?(INST|SYS|BOT|ROLE|TURN)\\]|\\\\*/?s>)',
                             '\\1\\\\\\2', 'g') AS marked,
           regexp_replace(role, '([\\[<])(\\\\*/?(INST|SYS|BOT|ROLE|TURN)\\]|\\\\*/?s>)',
                          '\\1\\\\\\2', 'g') AS marked_role
    FROM given),
rendered AS (
    SELECT conv_id, turn, role, text,
           CASE role {_KNOWN.replace("e.text", "marked")}
                ELSE '{OTHER[0]}' || marked_role || '{OTHER[1]}' || marked || '{OTHER[2]}' END
               AS segment
    FROM escaped)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
       CAST(sum(CASE WHEN role = '{LEARNED}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, segment)
                       FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
       CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id
"""
