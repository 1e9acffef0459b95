"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. A block of vectors posts each of them,
with its place, in the pivots' inverted files. A query walks the files of its own nearest pivots
and sums up differences in place (Spearman's footrule, where a pivot that is missing counts as
past the last place); the vectors with the smallest sums are ranked again by their distance.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import bounded_batches, cut, steady_memory

_NONE = np.iinfo(np.int64).max

PIVOTS = 4.0  # pivots for each root of the number of vectors: the sample that the index is fitted on
LENGTH = 64  # nearest pivots that make up a vector's representation
RERANKED = 16.0  # vectors that are ranked again by distance, for each root of their number
BLOCK_ROWS = 8192
QUERY_BLOCK = 16_384


def _ordered_pivots(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    d = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :length]


class Files:
    """Inverted files of one block of vectors: for each pivot the rows that it is near to, and its place."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, length: int):
        order = _ordered_pivots(vectors, pivots, length)
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.rows, self.places = (by // length).astype(np.int32), (by % length).astype(np.int32)
        self.starts = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        self.length = length
        self.size = len(vectors)

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Footrule of each vector to a query (its ordered pivots), less the part all share; 0 if they share no pivot."""
        total = np.zeros(self.size, np.int32)
        for place, pivot in enumerate(query):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            # a row is posted once in a file, so plain indexing adds up
            total[self.rows[a:b]] += np.abs(self.places[a:b] - place) - (self.length - place) - (self.length - self.places[a:b])
        return total


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, also where squares are too large for it."""
    with np.errstate(over="ignore"):
        apart = vectors - query
        d = np.sqrt((apart**2).sum(axis=1))
    for i in np.flatnonzero(~np.isfinite(d)):
        with np.errstate(over="ignore"):
            most = np.abs(vectors[i] / 2 - query / 2).max()
            d[i] = most * np.sqrt(((vectors[i] / 2 / most - query / 2 / most) ** 2).sum()) * 2
    return d


def _search(shared, k: int, share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        ids, queries, pivots, length = shared.value
        orders = _ordered_pivots(queries, pivots, length)
        best_d, best_v = np.full((len(ids), 2 * k), np.inf), np.full((len(ids), 2 * k), _NONE)

        def block(frames: list[pd.DataFrame]) -> None:
            vec_ids = np.concatenate([f["vec_id"].to_numpy(np.int64) for f in frames])
            vectors = np.stack([v for f in frames for v in f["embedding"]]).astype(np.float64)
            files = Files(vectors, pivots, length)
            take = min(len(vec_ids), max(k, int(np.ceil(share * len(vec_ids)))))
            for i, order in enumerate(orders):
                near = np.argpartition(files.footrule(order), take - 1)[:take]
                d = distances(vectors[near], queries[i])
                first = np.lexsort((vec_ids[near], d))[:k]
                best_d[i, k : k + len(first)], best_v[i, k : k + len(first)] = d[first], vec_ids[near[first]]
                best_d[i, k + len(first) :], best_v[i, k + len(first) :] = np.inf, _NONE
                keep = np.lexsort((best_v[i], best_d[i]))
                best_d[i], best_v[i] = best_d[i, keep], best_v[i, keep]

        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= BLOCK_ROWS:
                block(held)
                held = []
        if sum(map(len, held)):
            block(held)
        i, j = np.nonzero(best_v[:, :k] != _NONE)
        yield pd.DataFrame({"query_id": np.asarray(ids, np.int64)[i], "rep": best_v[i, j], "score": best_d[i, j]})

    return run


def _found(classes: DataFrame, asked: DataFrame, dim: int, k: int) -> list[DataFrame]:
    """(query_id, rep, score) of the nearest classes of each query, vectors all of one dimension."""
    spark = classes.sparkSession
    size = classes.count()
    chosen = classes.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(math.ceil(PIVOTS * math.sqrt(size))).collect()
    pivots = np.array([r["embedding"] for r in chosen], np.float64).reshape(-1, dim)
    length = min(LENGTH, len(pivots))
    share = RERANKED / math.sqrt(max(1, size))
    index = classes.repartition(max(1, -(-size // BLOCK_ROWS)), "vec_id")
    queries = asked.select("vec_id", "embedding").orderBy("vec_id").toLocalIterator()
    parts = []
    while rows := list(itertools.islice(queries, QUERY_BLOCK)):
        ids, own = np.array([r["vec_id"] for r in rows], np.int64), np.array([r["embedding"] for r in rows], np.float64)
        shared = spark.sparkContext.broadcast((ids, own, pivots, length))
        part = index.mapInPandas(_search(shared, k + 1, share), "query_id long, rep long, score double")
        if len(rows) == QUERY_BLOCK:  # the driver holds one block at a time
            part = cut(part)
            shared.unpersist()
        parts.append(part)
    return parts


def nearest(vectors: DataFrame, queries_where: str, k: int = 10) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score (Euclidean distance).

    vectors has vec_id and embedding; queries are its rows that satisfy queries_where, candidates
    all rows of the same dimension but those with the query's own vec_id, ordered by distance in
    double precision and then vec_id. Vectors that are null, empty, zero, or hold a null or
    non-finite component take no part, nor do rows without a vec_id; rows that repeat a vec_id and
    its vector count once. With k candidates or fewer all are returned. Other columns are ignored.

    Equal vectors are one class, of which the k + 1 smallest vec_ids are kept, so hot vectors cost
    nothing and ties come out exactly. Pivots (the classes with the smallest hash) grow as the root
    of the number of vectors, and so do the vectors that a query is compared with, so the files
    that a query walks get shorter as their number grows. The stated queries go to the executors
    in blocks of QUERY_BLOCK, each searched for in one pass over the index; per query a task
    returns k + 1 classes. Dimensions are searched one after another.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.expr(f"coalesce({queries_where}, false)").alias("asked"))
    usable = usable.where("vec_id is not null and embedding is not null").where(whole).dropDuplicates(["vec_id", "embedding"])
    dims = [r["dim"] for r in usable.groupBy(F.size("embedding").alias("dim")).agg(F.max("asked").alias("asked")).where("asked").orderBy("dim").collect()]
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    members = cut(usable.select("vec_id", "embedding").withColumn("n", F.row_number().over(alike)).where(f"n <= {k + 1}").withColumn("rep", F.min("vec_id").over(Window.partitionBy("embedding"))))
    classes = members.where("n = 1").select("vec_id", "embedding")
    found = [part for dim in dims for part in _found(classes.where(F.size("embedding") == dim), usable.where("asked").where(F.size("embedding") == dim), dim, k)]
    top = functools.reduce(DataFrame.union, found)
    top = top.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "rep"))).where(f"r <= {k + 1}").drop("r")
    spread = top.join(members.select("rep", "vec_id"), "rep").where("vec_id <> query_id")
    ranked = spread.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(f"rank <= {k}")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_nearest(spark, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours in `embeddings` of every row whose vec_id is divisible by 100."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")
