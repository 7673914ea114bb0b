"""Operator 13: centroid clustering (Lloyd's rounds) with heap-ordered bounds.

Components become integers, floor(scale * x). A vector keeps the gap between a lower bound of its
distance to any other centroid and an upper bound of that to its own. When centroids move, the gap
of all vectors of a cluster shrinks by at most the same amount: the cluster's own drift and the
largest drift of another one. So no bound is touched: each cluster adds these amounts up in an
offset, its vectors lie in a heap ordered by gap plus the offset at the time of entry, and only
those are popped whose key the offset has passed. They alone are rescanned exactly and pushed
again. A gap must exceed the offset by more than doubles may err, so ties are always rescanned,
and all that decides is compared in whole numbers.

Vectors lie in blocks of at most ``BLOCK`` rows, each with heaps of its own, so that no cluster is
ever in one place, however large. A round reads and writes the blocks without a shuffle, and sends
on what the moved vectors change in the clusters' sums; the driver holds k centroids only. Blocks
are written to the shared folder, so a lost executor costs a file read.

Takes part: vectors of exactly ``size`` components, none null or non-finite; nulls, empty vectors
and other lengths are left out. Components are held within +-2^27 (after scaling), so that squared
distances fit 64 bits; sums of distances stop at 2^63 - 1. The first k centroids are the vectors
with the smallest hash of their key, ties by their components; null keys come last. Repeated rows
and keys are vectors of their own; of equally near centroids the smaller number counts; fewer rows
than k give fewer centroids; an empty table gives an empty result. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayledger.sinks.folders import discard_folder

from .common import map_batches, table, working_folder, written

K = 16
ROUNDS = 3
SCALE = 64
SIZE = 64
SEED = 1
#: Vectors in a block.
BLOCK = 4096
#: Components are held within these bounds.
LARGEST = 1 << 27

_STATE = (
    "keys array<long>, vectors binary, owners binary, gaps binary, members binary, "
    "lengths binary, rescanned long, moves array<struct<cluster: int, n: long, sums: array<long>>>"
)


class Centroids(NamedTuple):
    """Of a round: whole components, and what each cluster's gaps have lost so far."""

    vectors: np.ndarray
    offsets: np.ndarray


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact: in doubles where these hold all values, else in long."""
    largest = max(int(np.abs(m).max(initial=0)) for m in (vectors, centroids))
    kind = np.float64 if 4 * vectors.shape[1] * largest**2 < 1 << 52 else np.int64
    v, c = vectors.astype(kind), centroids.astype(kind)
    found = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)
    return found.astype(np.int64)


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the gap to the second nearest."""
    far = _squares(vectors, centroids)
    own = far.argmin(axis=1)
    if far.shape[1] == 1:
        return own, np.full(len(own), np.inf)
    two = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(np.float64))
    return own, two[:, 1] - two[:, 0]


class _Block:
    """Vectors of one block, the cluster of each, and a heap of (key, place) for each cluster."""

    def __init__(self, vectors: np.ndarray, owners: np.ndarray, heaps: list[list]) -> None:
        self.vectors, self.owners, self.heaps = vectors, owners, heaps

    @classmethod
    def new(cls, vectors: np.ndarray, now: Centroids) -> _Block:
        block = cls(vectors, np.full(len(vectors), -1), [[] for _ in now.vectors])
        block.place(np.arange(len(vectors)), now)
        for heap in block.heaps:
            heapq.heapify(heap)
        return block

    @classmethod
    def load(cls, row: dict, size: int) -> _Block:
        vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, size)
        owners = np.frombuffer(row["owners"], np.int16).astype(np.int64)
        gaps = np.frombuffer(row["gaps"], np.float64).tolist()
        members = np.frombuffer(row["members"], np.int32).tolist()
        ends = np.cumsum(np.frombuffer(row["lengths"], np.int32)).tolist()
        entries = list(zip(gaps, members, strict=True))
        return cls(vectors, owners, [entries[a:b] for a, b in zip([0, *ends], ends, strict=False)])

    def dump(self) -> dict:
        entries = [e for heap in self.heaps for e in heap]
        return {
            "vectors": self.vectors.astype(np.int32).tobytes(),
            "owners": self.owners.astype(np.int16).tobytes(),
            "gaps": np.array([e[0] for e in entries], np.float64).tobytes(),
            "members": np.array([e[1] for e in entries], np.int32).tobytes(),
            "lengths": np.array([len(h) for h in self.heaps], np.int32).tobytes(),
        }

    def place(self, some: np.ndarray, now: Centroids, push=list.append) -> None:
        """Exact scan of some vectors, each of which then enters its cluster's heap."""
        found, gaps = _nearest(self.vectors[some], now.vectors)
        self.owners[some] = found
        for c, gap, at in zip(found.tolist(), gaps.tolist(), some.tolist(), strict=True):
            push(self.heaps[c], (gap + now.offsets[c], at))

    def expired(self, now: Centroids) -> np.ndarray:
        """Pops all whose key the cluster's offset has passed."""
        out = []
        for heap, offset in zip(self.heaps, now.offsets.tolist(), strict=True):
            while heap and heap[0][0] <= offset + 1e-9 * (1 + offset + abs(heap[0][0])):
                # A gap without end, as of an only centroid, never expires.
                if heap[0][0] == np.inf:
                    break
                out.append(heapq.heappop(heap)[1])
        return np.array(sorted(out), np.int64)

    def advance(self, now: Centroids) -> tuple[np.ndarray, np.ndarray]:
        """Rescans what has expired; places and former clusters of the rescanned."""
        some = self.expired(now)
        before = self.owners[some]
        if len(some):
            self.place(some, now, heapq.heappush)
        return some, before


def _moves(block: _Block, some: np.ndarray, before: np.ndarray, k: int) -> list[dict]:
    """What vectors that changed their cluster add to its sums, or take from them."""
    after = block.owners[some]
    changed = before != after
    some, before, after = some[changed], before[changed], after[changed]
    n = np.zeros(k, np.int64)
    sums = np.zeros((k, block.vectors.shape[1]), np.int64)
    for clusters, sign in ((after, 1), (before, -1)):
        for c in np.unique(clusters[clusters >= 0]):
            here = some[clusters == c]
            n[c] += sign * len(here)
            sums[c] += sign * block.vectors[here].sum(axis=0, dtype=np.int64)
    touched = np.flatnonzero((n != 0) | sums.any(axis=1))
    return [{"cluster": int(c), "n": int(n[c]), "sums": sums[c].tolist()} for c in touched]


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _state(rows: list[dict]) -> pa.RecordBatch:
    kinds = pa.schema([
        ("keys", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("vectors", "owners", "gaps", "members", "lengths")),
        ("rescanned", pa.int64()),
        ("moves", pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))),
    ])
    return pa.RecordBatch.from_pylist(rows, schema=kinds)


def _started(kept: DataFrame, now: Centroids, size: int, block_rows: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                block = _Block.new(_matrix(part.column("vector"), size), now)
                everyone = np.arange(part.num_rows)
                moves = _moves(block, everyone, np.full(part.num_rows, -1), len(now.vectors))
                keys = part.column("key").to_pylist()
                own = {"keys": keys, "rescanned": len(keys), "moves": moves}
                yield _state([block.dump() | own])

    return map_batches(kept, run, _STATE)


def _advanced(state: DataFrame, now: Centroids, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block.load(row, size)
                some, before = block.advance(now)
                moves = _moves(block, some, before, len(now.vectors))
                own = {"keys": row["keys"], "rescanned": len(some), "moves": moves}
                yield _state([block.dump() | own])

    return map_batches(state, run, _STATE)


def _finished(state: DataFrame, now: Centroids, size: int) -> DataFrame:
    """The last assignment: a row for each vector, with its exact squared distance."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block.load(row, size)
                some, _ = block.advance(now)
                apart = block.vectors.astype(np.int64) - now.vectors[block.owners]
                yield pa.record_batch(
                    {
                        "key": pa.array(row["keys"], pa.int64()),
                        "cluster": pa.array(block.owners, pa.int32()),
                        "distance": pa.array((apart * apart).sum(axis=1), pa.int64()),
                    }
                )

    return map_batches(state, run, "key long, cluster int, distance long")


def _drifted(now: Centroids, vectors: np.ndarray) -> Centroids:
    """New centroids; each offset grows by its own drift and the largest drift of another."""
    apart = vectors.astype(np.float64) - now.vectors.astype(np.float64)
    drift = np.sqrt((apart * apart).sum(axis=1))
    others = np.zeros(len(drift))
    if len(drift) > 1:
        first = int(drift.argmax())
        others[:] = drift[first]
        others[first] = np.delete(drift, first).max()
    return Centroids(vectors, now.offsets + (drift + others) * (1 + 1e-9))


class Clustering(NamedTuple):
    assigned: DataFrame  # key, cluster, distance
    centroids: np.ndarray
    rescanned: list[int]  # vectors that each round scanned exactly


def whole_vectors(
    df: DataFrame, key: str, vector: str, scale: int = SCALE, size: int = SIZE
) -> DataFrame:
    """``key, vector`` (whole numbers) of the vectors that take part."""
    x = F.col(vector)
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False))
    )
    bound = float(LARGEST)
    held = F.transform(
        x,
        lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(bound)), F.lit(-bound))),
    )
    return df.where((F.size(x) == size) & finite).select(
        F.col(key).cast("long").alias("key"), held.alias("vector")
    )


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    size: int = SIZE,
    seed: int = SEED,
    block_rows: int = BLOCK,
) -> Clustering:
    spark = df.sparkSession
    kept = whole_vectors(df, key, vector, scale, size)
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = kept.orderBy(place.asc_nulls_last(), "vector").limit(k).collect()
    vectors = np.array([r["vector"] for r in first], np.int64).reshape(-1, size)
    if not len(vectors):
        empty = spark.createDataFrame([], "key long, cluster int, distance long")
        return Clustering(empty, vectors, [])
    now = Centroids(vectors, np.zeros(len(vectors)))
    counts = np.zeros(len(vectors), np.int64)
    sums = np.zeros((len(vectors), size), dtype=object)
    folder, state, rescanned = None, None, []
    for _ in range(rounds):
        made = _started(kept, now, size, block_rows) if state is None else _advanced(state, now, size)
        newer = working_folder(spark)
        made.write.parquet(newer)
        state = spark.read.schema(_STATE).parquet(newer)
        if folder:
            discard_folder(spark, folder)  # all of it is in the newer one
        folder = newer
        rescanned.append(state.agg(F.sum("rescanned")).first()[0] or 0)
        moves = state.select(F.explode("moves").alias("m")).select(
            "m.cluster", "m.n", F.posexplode("m.sums").alias("place", "x")
        )
        # At most k * size rows.
        for r in moves.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
            sums[r["cluster"], r["place"]] += r["x"]
            if r["place"] == 0:
                counts[r["cluster"]] += r["n"]
        vectors = now.vectors.copy()
        for c in np.flatnonzero(counts):
            vectors[c] = [int(x) // int(counts[c]) for x in sums[c]]
        now = _drifted(now, vectors)
    if state is None:
        state = written(_started(kept, now, size, block_rows))
    assigned = written(_finished(state, now, size))
    return Clustering(assigned, now.vectors, rescanned)


def clusters(df: DataFrame, key: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256``, a row for each vector."""
    spark = df.sparkSession
    found = cluster(df, key, vector, **options)
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    # At most k rows.
    per_cluster = {r["cluster"]: int(r["inertia"]) for r in found.assigned.groupBy("cluster").agg(exact).collect()}
    most = (1 << 63) - 1
    total = min(most, sum(per_cluster.values()))
    rows = [
        (
            c,
            min(most, inertia),
            total,
            hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest(),
        )
        for c, inertia in sorted(per_cluster.items())
    ]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    stats = spark.createDataFrame(rows, kinds)
    return found.assigned.join(F.broadcast(stats), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS (
    SELECT v.row, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e,
           min({{'d': CAST(list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, c.e)
                         + list_dot_product(c.e, c.e) AS BIGINT), 'c': c.c}}) AS best
    FROM v, c{r} AS c GROUP BY v.row)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (
    SELECT c, list(x ORDER BY i) AS e
    FROM (SELECT best.c AS c, i, floor(sum(e[i]::HUGEINT)::DOUBLE / count(*)) AS x
          FROM a{r}, range(1, {SIZE + 1}) AS t(i) GROUP BY best.c, i)
    GROUP BY c),
c{r + 1} AS (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{r} AS c LEFT JOIN m{r} AS m USING (c))""")
    return f"""
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
    FROM embeddings
    WHERE len(embedding) = {SIZE}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c, e
    FROM v ORDER BY c LIMIT {K}),
{",".join(steps)}
SELECT vec_id, CAST(best.c AS INT) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.e, lambda x: CAST(x AS BIGINT)), ','))
           AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} AS c ON c.c = best.c
"""


OP13_SQL = _sql()
