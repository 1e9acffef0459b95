"""Exact Lloyd clustering of whole-number vectors with adaptive distance bounds.

A vector keeps an upper bound of the distance to its own centroid, lower bounds of the distances
to its next nearest centroids, and one lower bound of all the remaining ones. When centroids move,
bounds move by as much. As long as the upper bound is below all lower bounds, the nearest centroid
can't have changed; else distances are worked out for as many of the nearest centroids as it takes
for the rest to be out of reach, or for all. Distances are compared as whole numbers, ties go to
the smaller number, and bounds are rounded to the safe side, so the clusters are those of a full
scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import bounded_batches, remove, stored

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
_SAFE = 1 << 27  # differences of smaller components, squared and summed over 64, fit 64 bits
_MOST = 10**26
_FAR = 1e300
_EPS = 1e-15
_LONG = (1 << 63) - 1


def whole_numbers(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a batch's vectors, in 64 bits, or as Python's integers where squares wouldn't fit."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions) * scale)
    most = np.abs(x).max(initial=0)
    if most < _SAFE:
        return x.astype(np.int64)
    if not most < _MOST:
        raise ValueError(f"a component times {scale} is {most}: sums of more than {_MOST} don't fit")
    return np.array([[int(v) for v in row] for row in x], object)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return ((vectors - centroid) ** 2).sum(axis=1)


def _up(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + _EPS)


def _down(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 - _EPS)


class Bounds:
    """Clusters of a batch of vectors, with bounds: own (upper), near (centroids in order) and low (their lower bounds, the remainder's last)."""

    def __init__(self, vectors: np.ndarray, centroids: np.ndarray, own: np.ndarray, upper: np.ndarray, near: np.ndarray, low: np.ndarray):
        self.vectors, self.centroids = vectors, centroids
        self.own, self.upper, self.near, self.low = own, upper, near, low
        self.deepest = 0  # how many of the nearest had to be looked at, beside the own; more than there are if all
        self.scanned = 0  # distances that were worked out

    @classmethod
    def fresh(cls, vectors: np.ndarray, centroids: np.ndarray, kept: int) -> Bounds:
        n = len(vectors)
        out = cls(vectors, centroids, np.zeros(n, np.int32), np.zeros(n), np.zeros((n, kept), np.int32), np.zeros((n, kept + 1)))
        out._scan_all(np.arange(n))
        return out

    def _distances(self, rows: np.ndarray, which: np.ndarray | None) -> np.ndarray:
        """Exact squared distances of rows to the centroids marked in `which` (None: all); others are above any."""
        d = np.full((len(rows), len(self.centroids)), _MOST**3 if self.vectors.dtype == object else _LONG, self.vectors.dtype)
        for c, centroid in enumerate(self.centroids):
            some = slice(None) if which is None else np.flatnonzero(which[:, c])
            chosen = rows[some]
            d[some, c] = squared(self.vectors[chosen], centroid)
            self.scanned += len(chosen)
        return d

    def _scan_all(self, rows: np.ndarray) -> None:
        d, kept = self._distances(rows, None), self.near.shape[1]
        order = np.argsort(d, axis=1, kind="stable")
        ranked = np.take_along_axis(d, order, axis=1)
        self.own[rows], self.upper[rows] = order[:, 0], _up(ranked[:, 0])
        self.near[rows], self.low[rows, :kept] = order[:, 1 : kept + 1], _down(ranked[:, 1 : kept + 1])
        self.low[rows, kept] = _down(ranked[:, kept + 1]) if ranked.shape[1] > kept + 1 else _FAR

    def narrowed(self, kept: int) -> None:
        """Keeps fewer lower bounds of their own; those given up join the remainder."""
        if kept < self.near.shape[1]:
            self.low = np.column_stack([self.low[:, :kept], self.low[:, kept:].min(axis=1)])
            self.near = self.near[:, :kept]

    def move(self, moved: np.ndarray) -> None:
        """Lets bounds follow centroids, of which each moved by at most `moved`, and assigns anew where they don't decide."""
        self.upper = (self.upper + moved[self.own]) * (1 + _EPS)
        by = np.column_stack([moved[self.near], np.full(len(self.own), moved.max())])
        self.low = self.low - by - _EPS * (np.abs(self.low) + by)
        open_ = np.flatnonzero(self.upper >= self.low.min(axis=1))
        if not len(open_):
            return
        mine = np.empty(len(open_), self.vectors.dtype)
        for c in np.unique(self.own[open_]):
            at = np.flatnonzero(self.own[open_] == c)
            mine[at] = squared(self.vectors[open_[at]], self.centroids[c])
        self.scanned += len(open_)
        self.upper[open_] = _up(mine)
        least = np.minimum.accumulate(self.low[open_, ::-1], axis=1)[:, ::-1]  # of each bound and those behind it
        beyond = self.upper[open_, None] < least
        depth = np.where(beyond.any(axis=1), beyond.argmax(axis=1), least.shape[1])
        self.deepest = int(depth.max(initial=0))
        for z in np.unique(depth[depth > 0]):
            rows = open_[depth == z]
            if z == least.shape[1]:
                self._scan_all(rows)
                continue
            some = np.column_stack([self.own[rows], self.near[rows, :z]])
            which = np.zeros((len(rows), len(self.centroids)), bool)
            np.put_along_axis(which, some, True, axis=1)
            d = self._distances(rows, which)
            order = np.argsort(d, axis=1, kind="stable")[:, : z + 1]
            ranked = np.take_along_axis(d, order, axis=1)
            self.own[rows], self.upper[rows] = order[:, 0], _up(ranked[:, 0])
            self.near[rows, :z], self.low[rows, :z] = order[:, 1:], _down(ranked[:, 1:])


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32) if rows.shape[1] else np.zeros(len(rows) + 1, np.int32), pa.array(rows.ravel()))


_STATE = "vec_id long, embedding array<{kind}>, own int, upper double, near array<int>, low array<double>"
_SUMS = "cluster int, n long, deepest int, sums array<decimal(38,0)>"


def _assigned(shared, dimensions: int, scale: int, last: bool):
    """Rows of a round: vectors with their new bounds (in the last one with their distance), and behind them each cluster's sums in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, moved, kept = shared.value
        k = len(centroids)
        counts, sums, deepest = [0] * k, [[0] * dimensions for _ in range(k)], 0
        kind = None
        for batch in batches:
            kind = batch.column("embedding").type
            vectors = whole_numbers(batch.column("embedding"), dimensions, scale)
            exact = centroids if vectors.dtype == np.int64 and all(abs(x) < _SAFE for c in centroids for x in c) else None
            if exact is None:
                vectors = vectors.astype(object)
            c = np.array(centroids, vectors.dtype)
            if moved is None:
                b = Bounds.fresh(vectors, c, kept)
            else:
                shaped = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                b = Bounds(vectors, c, batch.column("own").to_numpy().copy(), batch.column("upper").to_numpy().copy(), shaped("near").copy(), shaped("low").copy())
                b.narrowed(kept)
                b.move(moved)
            if last:
                d = [min(_LONG, int(x)) for x in squared(vectors, c[b.own])]
                yield pa.record_batch([batch.column("vec_id"), pa.array(b.own), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])
                continue
            deepest = max(deepest, b.deepest)
            for i in np.unique(b.own):
                rows = vectors[b.own == i]
                counts[i] += len(rows)
                sums[i] = [x + int(y) for x, y in zip(sums[i], rows.sum(axis=0))]
            n = batch.num_rows
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(b.own), pa.array(b.upper), _lists(b.near), _lists(b.low), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.decimal128(38, 0)))], names
            )
        used = [i for i in range(k) if counts[i]]
        if used and not last:
            n = len(used)
            total = pa.array([[Decimal(x) for x in sums[i]] for i in used], pa.list_(pa.decimal128(38, 0)))
            yield pa.record_batch(
                [pa.nulls(n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.float64())), pa.array(used, pa.int32()), pa.array([counts[i] for i in used], pa.int64()), pa.array([deepest] * n, pa.int32()), total], names
            )

    names = [c.split()[0] for c in (_STATE + ", " + _SUMS).split(", ")]
    return run


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each vector, and the final centroids.

    vectors has vec_id and embedding; other columns are ignored, as are rows whose embedding is
    null, has another number of components, or holds a null or non-finite one. Components are
    floor(scale * x). Rows that repeat a vec_id count each for itself, a null vec_id is hashed as
    empty. With fewer than k vectors there are as many clusters; with none the result is empty.
    Components of 10^26 or more raise an error; smaller ones are exact, distances beyond 64 bits
    are given as the largest long.

    Each round reads the vectors with their bounds, writes them with new ones and the tasks' sums,
    and removes the table before. A vector starts with k / 4 lower bounds of its own; a round
    keeps no more than the one before it had to look at. The driver gets k rows a round.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding")).where(F.size("embedding") == dimensions).where(fine)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = own.orderBy(hashed, "embedding").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = [[math.floor(scale * float(x)) for x in r["embedding"]] for r in first]
    kept, moved, state, path = min(-(-len(centroids) // 4), len(centroids) - 1), None, own, None
    total = F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dimensions)])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((centroids, moved, kept))
        out, written = stored(state.mapInArrow(_assigned(shared, dimensions, scale, False), f"{_STATE.format(kind=kind)}, {_SUMS}"))
        rows = out.where("cluster is not null").groupBy("cluster").agg(F.sum("n").alias("n"), F.max("deepest").alias("deepest"), total.alias("sums")).collect()
        if path:
            remove(spark, path)
        state, path = out.where("cluster is null").drop("cluster", "n", "deepest", "sums"), written
        after = list(centroids)
        for r in rows:
            after[r["cluster"]] = [int(x) // r["n"] for x in r["sums"]]
        moved = np.array([math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))) for a, b in zip(centroids, after)]) * (1 + _EPS)
        deepest = max(r["deepest"] for r in rows)
        kept = kept if not deepest else min(kept, max(deepest, -(-len(centroids) // 8)))
        centroids = after
        shared.unpersist()
    shared = spark.sparkContext.broadcast((centroids, moved, kept))
    out, _ = stored(state.mapInArrow(_assigned(shared, dimensions, scale, True), "vec_id long, cluster int, distance long"))
    if path:
        remove(spark, path)
    return out, centroids


def summed(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """found with cluster_inertia, inertia (distances summed over the cluster and all, at most the largest long) and centroid_sha256."""
    spark = found.sparkSession
    bounded = lambda c: F.least(c, F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("own"))
    per = per.select("cluster", bounded(F.col("own")).alias("cluster_inertia"))
    whole = found.agg(bounded(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)")).alias("inertia"))
    named = spark.createDataFrame([(i, ",".join(map(str, c))) for i, c in enumerate(centroids)], "cluster int, components string")
    named = named.select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    # one row a cluster
    return found.join(F.broadcast(per.join(named, "cluster").crossJoin(whole)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_clustering(spark, sf_dir: str) -> DataFrame:
    """Eight clusters of all 64-dimensional `embeddings`, ten rounds."""
    return summed(*clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")))


def _sql() -> str:
    """Ten rounds of full scans, one after another."""
    assign = """a{i} AS MATERIALIZED (
  SELECT v.rid, v.vec_id, v.x, min_by(c.cluster, c.d) AS cluster, min(c.d) AS distance FROM v JOIN (
    SELECT v.rid, c.cluster, (list_sum(list_transform(range(1, {n} + 1), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT, c.cluster) AS d FROM v, c{i} c) c USING (rid)
  GROUP BY ALL)"""
    update = """c{j} AS MATERIALIZED (
  SELECT c.cluster, coalesce(s.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT cluster, list(m ORDER BY j) AS x FROM (
      SELECT cluster, j, ((sum(x[j]) - ((sum(x[j]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM a{i}, range(1, {n} + 1) r(j) GROUP BY cluster, j) GROUP BY cluster) s USING (cluster))"""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster, x FROM v ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CLUSTERS})",
    ]
    for i in range(ROUNDS):
        parts += [assign.format(i=i, n=DIMENSIONS), update.format(i=i, j=i + 1, n=DIMENSIONS)]
    parts.append(assign.format(i=ROUNDS, n=DIMENSIONS))
    return f"""WITH {', '.join(parts)}
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance[1]::BIGINT AS distance, sum(a.distance[1]) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance[1]) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""


OP13_SQL = _sql()
