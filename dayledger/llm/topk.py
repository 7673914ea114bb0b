"""Operator 4: exact top-k inner product search by columnar branch and bound.

Components become integers, floor(scale * x). Queries are a stated set; each block of them is held
against all candidates, which lie in blocks too, component by component (vertical layout, the
components with the most mass first). A block adds up scores one group of components after the
other for all its pairs; after each group, what the remaining components can still add to a pair
is bounded by the lengths of the remainders (Cauchy-Schwarz), and only candidates that can still
reach some query's k-th best score so far are kept, compacted into smaller columns. Scores are
integers throughout, so the result is exact.

A candidate block returns its k best for each query at most, which are merged per query. Vectors
that are null or hold null or non-finite components take no part; nor does a query's own row, told
by its key. Fewer than k candidates: all. Ties go to the smaller key. Rows with a null key are no
queries and no candidates; vectors of another length than the first of their block's
queries meet only queries of their own length.

Repeated rows are candidates each. An empty table, or one without queries, gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import map_batches, table, to_driver, written

K = 10
SCALE = 1024
#: Components that are added before candidates are looked through again.
GROUP = 8
#: Queries that are held at once, as bytes; more of them are more passes over the candidates.
QUERY_BYTES = 8 << 20
#: Candidates in a block.
BLOCK = 4096


class _Queries:
    """Queries of one length, and the k best found for each so far."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.keys, self.k = keys, k
        self.vectors = vectors.astype(np.float64)
        self.largest = int(np.abs(vectors.astype(object)).max(initial=0))
        self.exact = vectors
        # Components with the most mass come first, so that the remainders shrink early.
        self.order = np.argsort(-(self.vectors**2).sum(axis=0), kind="stable")
        self.sorted = self.vectors[:, self.order]
        self.best: list[list[tuple[int, int]]] = [[] for _ in keys]  # (-score, key)
        self.least = np.full(len(keys), -np.inf)

    def meet(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        d = vectors.shape[1]
        largest = int(np.abs(vectors.astype(object)).max(initial=0))
        if d * largest * self.largest >= 1 << 52:
            # Beyond what doubles hold: whole numbers of any size, without bounds.
            scores = self.exact.astype(object) @ vectors.astype(object).T
            limit = 1 << 63
            for q in range(len(self.keys)):
                self._take(q, keys, [max(-limit, min(limit - 1, int(s))) for s in scores[q]])
            return
        columns = np.ascontiguousarray(vectors.astype(np.float64).T[self.order])
        mass = np.sqrt(_after(columns**2))
        for at in range(0, len(self.keys), 64):
            self._block(slice(at, at + 64), keys, columns, mass)

    def _block(self, part: slice, keys: np.ndarray, columns: np.ndarray, mass: np.ndarray) -> None:
        queries = self.sorted[part]
        own = np.sqrt(_after((queries**2).T))
        least = self.least[part]
        scores = np.zeros((len(queries), columns.shape[1]))
        alive = np.arange(columns.shape[1])
        for g in range(0, len(columns), GROUP):
            end = min(g + GROUP, len(columns))
            scores += queries[:, g:end] @ columns[g:end][:, alive]
            if end == len(columns):
                break
            # Rounding of the lengths is far below one part in 10 ** 9.
            reach = scores + (own[end][:, None] * mass[end][alive]) * (1 + 1e-9) + 1e-6
            keep = (reach >= least[:, None]).any(axis=0)
            if not keep.all():
                alive, scores = alive[keep], scores[:, keep]
            if not len(alive):
                return
        for q in range(len(queries)):
            hit = scores[q] >= least[q]
            if hit.any():
                self._take(part.start + q, keys[alive[hit]], scores[q][hit].astype(np.int64))

    def _take(self, q: int, keys: np.ndarray, scores) -> None:
        scores = np.asarray(scores, np.int64)
        other = keys != self.keys[q]
        keys, scores = keys[other], scores[other]
        if len(scores) > 4 * self.k:
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            enough = scores >= kth
            keys, scores = keys[enough], scores[enough]
            first = np.lexsort((keys, -scores))[: self.k]
            keys, scores = keys[first], scores[first]
        found = zip((-s for s in scores.tolist()), keys.tolist(), strict=True)
        self.best[q] = sorted([*self.best[q], *found])[: self.k]
        if len(self.best[q]) == self.k:
            self.least[q] = -self.best[q][-1][0]


def _after(squares: np.ndarray) -> np.ndarray:
    """Row g: the sum of rows g and later, for each column."""
    return np.cumsum(squares[::-1], axis=0)[::-1]


def _matrices(keys: pa.Array, lists: pa.Array):
    """Keys and vectors by length."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat, own = lists.flatten().to_numpy(), keys.to_numpy()
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), own[rows], flat[starts[rows][:, None] + np.arange(d)].reshape(len(rows), d)


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``key, vector`` as whole numbers (bounded by a long's range), valid rows only."""
    x = F.col(vector)
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False))
    )
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    return df.where(F.col(key).isNotNull() & x.isNotNull() & finite).select(
        F.col(key).cast("long").alias("key"), whole.alias("vector")
    )


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its k best among all other rows.

    Repeated rows are candidates of their own; a query whose key repeats is asked once, with the
    least of its vectors.
    """
    all_rows = whole_vectors(df, key, vector, scale)
    asked = whole_vectors(df.where(is_query), key, vector, scale)
    asked = asked.groupBy("key").agg(F.min("vector").alias("vector"))
    asked = written(asked)
    size = asked.agg(F.sum(8 * F.size("vector") + 64).alias("bytes")).first()["bytes"] or 0
    passes = max(1, -(-size // query_bytes))
    found = None
    for p in range(passes):
        part = asked.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == p)
        # A hash deals out the queries, so that twice the mean is far beyond what a pass gets.
        rows = to_driver(part.select("key", "vector"), 2 * query_bytes // 64)
        best = _pass(all_rows, [(r["key"], r["vector"]) for r in rows], k)
        found = best if found is None else found.union(best)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Each task sends k rows of a query at most.
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id"), "score")


def _pass(all_rows: DataFrame, queries: list[tuple[int, list[int]]], k: int) -> DataFrame:
    sent = all_rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for key, vector in sent.value:
            by_length.setdefault(len(vector), []).append((key, vector))
        own = {
            d: _Queries(
                np.array([q for q, _ in some], np.int64),
                np.array([v for _, v in some], np.int64).reshape(len(some), d),
                k,
            )
            for d, some in by_length.items()
        }
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                for d, keys, vectors in _matrices(block.column("key"), block.column("vector")):
                    if d in own:
                        own[d].meet(keys, vectors)
        rows = [
            (int(q), key, -negative)
            for queries_ in own.values()
            for q, best in zip(queries_.keys, queries_.best, strict=True)
            for negative, key in best
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        names = ("query_id", "vec_id", "score")
        yield pa.record_batch(
            {n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)}
        )

    return map_batches(all_rows, run, "query_id long, vec_id long, score long")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP4_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                          AS INT) AS rank, vec_id, score
    FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""
