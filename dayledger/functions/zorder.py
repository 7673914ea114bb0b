"""A key along which rows near in several columns lie near each other.

Each column's values are cut into 2^bits ranges of about equally many rows, and the bits of the range
numbers are interleaved. Files written in the order of this key have narrow minima and maxima in all of
the columns, so that a filter on any of them skips most files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Ranges per column, as a power of two.
BITS = 6
_BYTES = 7


def _text_key(column: str, skip: int) -> Column:
    """Text as a number of the same order, as far as seven bytes after the common beginning tell."""
    part = F.substring(F.encode(F.col(column), "utf-8"), skip + 1, _BYTES)
    return F.conv(F.rpad(F.hex(part), 2 * _BYTES, "0"), 16, 10).cast("long")


def _common(texts: list[str | None]) -> int:
    """Bytes that the least and the greatest text begin with, and so all between them."""
    low, high = ((t or "").encode() for t in texts)
    n = 0
    while n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return n


def numbers(df: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """Each column as a number of the same order; NULL comes first."""
    kinds = [df.schema[c].dataType for c in columns]
    texts = [c for c, kind in zip(columns, kinds, strict=True) if isinstance(kind, T.StringType)]
    ends = df.agg(*[f(c).alias(f"{name}_{k}") for k, c in enumerate(texts)
                    for name, f in (("low", F.min), ("high", F.max))]).first() if texts else {}
    out = []
    for c, kind in zip(columns, kinds, strict=True):
        if isinstance(kind, T.StringType):
            k = texts.index(c)
            out.append(_text_key(c, _common([ends[f"low_{k}"], ends[f"high_{k}"]])))
        elif isinstance(kind, T.DateType):
            out.append(F.unix_date(c).cast("long"))
        elif isinstance(kind, T.TimestampType):
            out.append(F.unix_micros(c))
        elif isinstance(kind, T.NumericType):
            out.append(F.col(c).cast("double"))
        else:
            raise ValueError(f"{c} has no order to lay files out by: {kind.simpleString()}")
    return out


def _passed(value: Column, edges: list) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < value))


def _bounds(df: DataFrame, values: list[Column], bits: int) -> list[list | None]:
    """Of each column, at most 2^bits numbers."""
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = [F.percentile_approx(v, cuts, 10_000).alias(f"b{k}") for k, v in enumerate(values)]
    return list(df.agg(*found).first())


def _edges(bounds: list | None) -> list:
    """Bounds in order, each once. No number lies above NaN."""
    return sorted({edge for edge in bounds or [] if edge == edge})


def _interleaved(place: int, bits: int, step: int, first: int) -> int:
    return sum((place >> bit & 1) << (bit * step + first) for bit in range(bits))


def with_z_key(
    df: DataFrame, columns: tuple[str, ...], name: str = "_z", bits: int = BITS
) -> DataFrame:
    """Adds the key of each row. The bounds of the ranges come from one pass over the columns alone.

    The range of a value is found by halving, one comparison with a constant per bit. Each step is a
    column of its own, so that it is computed once; null is in the first range.
    """
    values = numbers(df, columns)
    bounds = _bounds(df, values, bits)
    own = {k: (f"{name}_value{k}", f"{name}_place{k}") for k in range(len(values))}
    keyed = df.withColumns({own[k][0]: value for k, value in enumerate(values)})
    tables = {}
    for k in own:
        edges = _edges(bounds[k])
        # No value is above a missing bound.
        kind = keyed.schema[own[k][0]].dataType.simpleString()
        edges += [None] * ((1 << bits) - 1 - len(edges))
        tables[k] = F.array(*[F.lit(edge).cast(kind) for edge in edges])
    keyed = keyed.withColumns({place: F.lit(0) for _, place in own.values()})
    for bit in reversed(range(bits)):
        step = 1 << bit
        steps = {}
        for k, (value, place) in own.items():
            above = F.col(value) > F.get(tables[k], F.col(place) + (step - 1))
            steps[place] = F.col(place) + F.when(above, step).otherwise(0)
        keyed = keyed.withColumns(steps)
    key = F.lit(0).cast("long")
    for k, (_, place) in own.items():
        codes = [_interleaved(n, bits, len(own), k) for n in range(1 << bits)]
        key = key.bitwiseOR(F.get(F.array(*[F.lit(c).cast("long") for c in codes]), F.col(place)))
    return keyed.withColumn(name, key).drop(*[c for pair in own.values() for c in pair])


def z_key(df: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> Column:
    """The same key as one expression, which compares each value with all bounds: for small tables."""
    values = numbers(df, columns)
    key = F.lit(0).cast("long")
    for k, (value, found) in enumerate(zip(values, _bounds(df, values, bits), strict=True)):
        edges = _edges(found)
        place = F.lit(0)
        if edges:
            place = F.when(value.isNull(), 0).otherwise(_passed(value, edges))
        for bit in range(bits):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(values) + k))
    return key
