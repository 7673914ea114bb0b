"""Operator 10: benchmark decontamination, with DataFrame functions only.

An item of n words (runs of letters, marks and digits, in lower case) has N = n - 4 shingles of
five words. A document holds the item if some n words in a row of it, or all its words where
they are fewer, have weighted similarity 0.8 or more to it: the shingles both have (with repeats, as often as both) over those that either
has. Such a window shares c = 2 t N / (1 + t) shingles with the item at least (t the threshold), so
it holds one of the item's anchors: its rarest shingles, so many that all others are fewer than c.
A document with fewer words than the item is one window as a whole, if it has t N shingles or more;
as it may share no more than these, it is also met at further anchors.

Documents' shingles meet the anchors; around each meeting the item-sized windows that hold c or
more of the item's shingles get a SimHash, a shingle counting as often as it occurs. The items'
fingerprints are indexed by 24 blocks of bits: two fingerprints within 23 bits agree in one block
at least, so that looking up a window's blocks finds every item within the radius. The similarity
of these candidates is then exact. Windows of equal content are one row in all of this.

At similarity 0.8 fingerprints differ in 9.7 bits on average (deviation 2.9), and the more similar
the less, so that the radius loses a window in a hundred thousand. Shorter documents, one window
for each item at most, get their exact similarity without it.

Items of fewer than five words, null texts and null items take no part. Repeated items, and
documents with the same key, count as one. The result has a row per document key and item.

Texts are compared whole, however long. Empty tables, on either side, give an empty result. Only the
keys and texts are read, whatever other columns are named.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, written

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
BLOCKS = 24
#: Anchors that are broadcast at once (two longs each); more are met in several passes.
PASS_ANCHORS = 500_000


def word_hashes(text: Column) -> Column:
    """Of each word; empty for null."""
    words = F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")
    return F.transform(F.filter(F.coalesce(words, F.array()), lambda w: w != ""), lambda w: F.xxhash64(w))


def _shingle(words: Column, at: Column) -> Column:
    """Of the five words from ``at`` on, counted from 0."""
    return F.xxhash64(*(F.get(words, at + k) for k in range(SHINGLE)))


def _shingles(words: Column) -> Column:
    """All in order; there must be five words."""
    starts = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    return F.transform(starts, lambda at: _shingle(words, at))


def fingerprint(shingles: Column) -> Column:
    """SimHash: a bit is set if it is in more than half of the shingles, repeats included."""
    n = F.size(shingles)
    # Two counters of 32 bits in one long.
    lanes, none = F.lit((1 << 32) | 1), F.lit(0).cast("long")

    def counters(k: int) -> Column:
        return F.aggregate(
            shingles, none, lambda sum_, h: sum_ + F.shiftrightunsigned(h, k).bitwiseAND(lanes)
        )

    bits = []
    for k in range(32):
        both = counters(k)
        low = 2 * both.bitwiseAND(F.lit(0xFFFFFFFF)) > n
        high = 2 * F.shiftrightunsigned(both, 32) > n
        top = 1 << (k + 32) if k < 31 else -(1 << 63)
        bits += [F.when(low, 1 << k).otherwise(none), F.when(high, top).otherwise(none)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def blocks(value: Column) -> Column:
    """An array of block number and bits, in one long each."""
    edges = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    return F.array(
        *(
            F.lit(k << 32).bitwiseOR(
                F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            )
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        )
    )


def _least(a: Column, b: Column, threshold: float) -> Column:
    """Shingles that a set of a and one of b must share at least."""
    return F.ceil(threshold * (a + b) / (1 + threshold) - 1e-9).cast("int")


def _items(benchmark: DataFrame, item: str, text: str, threshold: float) -> DataFrame:
    words = benchmark.select(F.col(item).alias("item"), word_hashes(F.col(text)).alias("words"))
    long_enough = words.where(F.col("item").isNotNull() & (F.size("words") >= SHINGLE))
    shingles = long_enough.select("item", _shingles(F.col("words")).alias("shingles")).distinct()
    n = F.size("shingles")
    return shingles.select(
        "item",
        F.xxhash64("shingles").alias("version"),  # the same item may come with two texts
        "shingles",
        n.alias("n"),
        _least(n, n, threshold).alias("least"),
        F.ceil(threshold * n - 1e-9).cast("int").alias("least_short"),
        fingerprint(F.col("shingles")).alias("item_print"),
    )


def _anchors(items: DataFrame) -> DataFrame:
    """``(h, item, version, below)``: an item's rarest shingles, all others being fewer than ``least``.

    Further ones, until all others are fewer than ``least_short``, are for documents of fewer than
    ``below`` shingles; it is null for those that are for all.
    """
    about = ["item", "version", "n", "least", "least_short"]
    each = items.select(*about, F.explode("shingles").alias("h"))
    each = each.groupBy(*about, "h").agg(F.count(F.lit(1)).alias("own"))
    rarity = each.groupBy("h").agg(F.sum("own").alias("all"))
    ranked = (
        each.join(rarity, "h")
        .groupBy(*about)
        .agg(F.sort_array(F.collect_list(F.struct("all", "h", "own"))).alias("each"))
    )
    # An item's shingles in order of rarity, with the number of those before: a sum over an
    # array that is as long as the item.
    place = F.transform(
        F.col("each"),
        lambda x, k: F.struct(
            x["h"].alias("h"),
            F.aggregate(F.slice("each", F.lit(1), k), F.lit(0).cast("long"), lambda s, y: s + y["own"]).alias("before"),
        ),
    )
    chosen = F.filter(place, lambda x: F.col("n") - x["before"] >= F.col("least_short"))
    left = F.col("n") - F.col("x")["before"]
    return ranked.select("item", "version", "n", "least", F.explode(chosen).alias("x")).select(
        F.col("x")["h"].alias("h"), "item", "version",
        F.when(left < F.col("least"), F.col("n")).alias("below"),
    )


def _windows(
    docs: DataFrame, anchors: DataFrame, items: DataFrame, key: str, text: str, threshold: float
) -> DataFrame:
    """``(key, start, item, version, short, shingles)``: windows with enough shingles of an item."""
    words = docs.select(F.col(key).alias("key"), word_hashes(F.col(text)).alias("words")).where(
        F.size("words") >= SHINGLE
    )
    placed = words.select(
        "key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - SHINGLE)).alias("at")
    )
    # Hashes are made and looked up row by row, where the words lie; nothing is shuffled.
    has = F.size("words") - (SHINGLE - 1)
    met = (
        placed.withColumn("h", _shingle(F.col("words"), F.col("at")))
        .join(F.broadcast(anchors), "h")
        .where(F.col("below").isNull() | (has < F.col("below")))
    )
    about = F.broadcast(
        items.select("item", "version", "n", "least_short", F.col("shingles").alias("own"))
    )
    n = F.col("n")
    width = F.least(n, has)  # all of a shorter document
    # The shingles of all windows that hold this place: n - 1 before it to n - 1 after it.
    first = F.greatest(F.lit(0), F.col("at") - n + 1)
    last = F.least(F.size("words") - SHINGLE, F.col("at") + n - 1)
    near = met.join(about, ["item", "version"]).where(width >= F.col("least_short")).select(
        "key", "item", "version", "own", first.alias("first"), width.alias("width"),
        (width < n).alias("short"), _least(width, n, threshold).alias("least"),
        F.transform(
            F.sequence(first, last), lambda p: _shingle(F.col("words"), p)
        ).alias("near"),
    )
    # Before each place: the number of places that hold a shingle of the item.
    held = F.transform("near", lambda h: F.array_contains("own", h).cast("int"))
    counted = near.withColumn("held", held).where(
        F.aggregate("held", F.lit(0), lambda s, x: s + x) >= F.col("least")
    )
    width = F.col("width")
    starts = F.filter(
        F.sequence(F.lit(0), F.size("near") - width),
        lambda s: F.aggregate(F.slice("held", s + 1, width), F.lit(0), lambda t, x: t + x)
        >= F.col("least"),
    )
    return counted.select("*", F.explode(starts).alias("s")).select(
        "key", "item", "version", "short", (F.col("first") + F.col("s")).alias("start"),
        F.slice("near", F.col("s") + 1, width).alias("shingles"),
    ).distinct()


def similarity(a: Column, b: Column) -> Column:
    """Weighted: shingles as often as both have them, over as often as either has them."""
    both = F.aggregate(
        F.array_distinct(a),
        F.lit(0),
        lambda total, h: total
        + F.least(
            F.size(F.filter(a, lambda x: x == h)), F.size(F.filter(b, lambda x: x == h))
        ),
    )
    return both / (F.size(a) + F.size(b) - both)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    pass_anchors: int = PASS_ANCHORS,
) -> DataFrame:
    """``key, item, start, similarity``: each document with the items it holds.

    ``start`` is the first word (from 0) of the most similar window, the first of such windows.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"{BLOCKS} blocks guarantee less than {BLOCKS} bits")
    items = written(_items(benchmark, item, item_text, threshold))
    anchors = written(_anchors(items))
    passes = max(1, -(-anchors.count() // pass_anchors))
    found = None
    for k in range(passes):
        chosen = F.pmod(F.xxhash64("item", "version"), F.lit(passes)) == k
        part = _windows(docs, anchors.where(chosen), items.where(chosen), key, text, threshold)
        found = part if found is None else found.union(part)
    windows = written(found)
    contents = windows.select("item", "version", "short", "shingles").distinct()
    printed = contents.where(~F.col("short")).withColumn("print", fingerprint(F.col("shingles")))
    looked_up = printed.select("*", F.explode(blocks(F.col("print"))).alias("block"))
    index = items.select(
        "item", "version", F.col("shingles").alias("own"), "item_print",
        F.explode(blocks(F.col("item_print"))).alias("block"),
    )
    within = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    candidates = (
        looked_up.join(index, ["item", "version", "block"])
        .where(within)
        .select("item", "version", "shingles", "own")
        .distinct()
    )
    whole = contents.where("short").join(
        items.select("item", "version", F.col("shingles").alias("own")), ["item", "version"]
    )
    verified = candidates.union(whole.select(*candidates.columns)).select(
        "item", "version", "shingles", similarity(F.col("shingles"), F.col("own")).alias("similarity")
    ).where(F.col("similarity") >= threshold)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return (
        windows.join(verified, ["item", "version", "shingles"])
        .groupBy("key", "item")
        .agg(best)
        .select(
            F.col("key").alias(key),
            F.col("item").alias(item),
            (-F.col("best")["back"]).alias("start"),
            F.col("best")["similarity"].alias("similarity"),
        )
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = """
WITH doc AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+') AS w FROM documents),
item AS (
    SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{N}]+') AS w FROM benchmark),
doc_shingle AS (
    SELECT doc_id, len(w) AS words, unnest(range(len(w) - 4)) AS p,
           unnest([array_to_string(w[i + 1:i + 5], ' ') FOR i IN range(len(w) - 4)]) AS s
    FROM doc WHERE len(w) >= 5),
item_shingle AS (
    SELECT item_id, n, s, count(*) AS own FROM (
        SELECT item_id, len(w) - 4 AS n,
               unnest([array_to_string(w[i + 1:i + 5], ' ') FOR i IN range(len(w) - 4)]) AS s
        FROM item WHERE len(w) >= 5) GROUP BY ALL),
hit AS (
    SELECT doc_id, words, p, s, item_id, n, own FROM doc_shingle JOIN item_shingle USING (s)),
placed AS (  -- every window that holds the place
    SELECT *, unnest(range(greatest(0, p - n + 1), least(p, words - 4 - n) + 1)) AS start FROM hit),
shared AS (
    SELECT doc_id, item_id, n, start, s, least(count(*), any_value(own)) AS common
    FROM placed GROUP BY doc_id, item_id, n, start, s),
scored AS (
    SELECT doc_id, item_id, start, sum(common) / (2 * n - sum(common)) AS similarity
    FROM shared GROUP BY doc_id, item_id, n, start)
SELECT doc_id, item_id, CAST(arg_max(start, (similarity, -start)) AS INT) AS start,
       max(similarity) AS similarity
FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""
