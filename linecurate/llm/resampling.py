"""Resampling of documents towards a target distribution by hashed word runs.

A text is scanned once. A ring holds the running zlib state of the runs that the last n words
started; each further word extends every state by a space and itself, and starts one more. The
states are the runs' crc32 values, so no run is ever put together as bytes.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import deque
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import numbered
from .runtime import bounded_batches, cut
from .textblocks import lowered

LONGEST = 1  # words in a run
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
CHUNK = 1 << 16  # features that are held at once
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bucket_runs(raw: bytes, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, int]]:
    """(buckets of all runs of 1 to `longest` words, number of words) of a lower-cased text, chunk by chunk."""
    ring: deque[int] = deque()
    out, words = array("Q"), 0
    for found in _WORD.finditer(raw):
        word = found.group()
        if longest > 1:
            if len(ring) == longest:
                ring.popleft()
            spaced = b" " + word
            for i, state in enumerate(ring):
                ring[i] = crc32(spaced, state)
            ring.append(crc32(word))
            out.extend(ring)
        else:  # a ring of one start
            out.append(crc32(word))
        words += 1
        if len(out) >= CHUNK:
            yield np.frombuffer(out, np.uint64) % np.uint64(buckets), words
            out, words = array("Q"), 0
    yield np.frombuffer(out, np.uint64) % np.uint64(buckets), words


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all texts; each task adds up its own and sends a row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for ids, _ in bucket_runs(lowered(text.as_py()), longest, buckets):
                    total += np.bincount(ids.astype(np.int64), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of how much likelier a bucket is in the target), with one added to each count."""
    buckets, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, shared, longest: int, buckets: int) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of each row: the sum of gains over its text's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for i, text in enumerate(batch.column(1)):
                for ids, words in bucket_runs(lowered(text.as_py()), longest, buckets):
                    rows[i] += (len(ids), words, gain[ids].sum())
            yield pa.record_batch([batch.column(0), *map(pa.array, np.ascontiguousarray(rows.T))], ["doc_id", "n_features", "n_words", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row for each row of docs: doc_id, n_features, weight, score, rank.

    Both tables have `text`, docs also doc_id; other columns are ignored. A feature is a run of 1 to
    `longest` words of a text whose A-Z were lower-cased, repeats counted; it falls into the bucket
    of its crc32. weight sums the buckets' gains over a document's features, score adds Gumbel
    noise, a hash of seed and doc_id. Of the documents with at least least_words words, `percent`
    in a hundred with the highest scores are drawn and ranked from 1, ties to the smaller doc_id;
    for the others rank is null. Null and empty texts have no features and weight 0; a null doc_id
    is hashed as empty and comes last among ties; rows that repeat a doc_id are drawn each for
    itself. Without a target text every gain follows from docs alone; without docs the result is empty.

    Counts cover all texts and are one row a bucket on the driver. Documents are scanned twice, once
    for counts and once for weights; narrow rows are checkpointed and put in order by ranges, so no
    task ranks them all.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    totals = np.zeros((2, buckets), np.int64)
    for row, table in zip(totals, (docs, target)):
        for r in bucket_counts(table, longest, buckets).collect():
            row[r["bucket"]] = r["n"]
    shared = spark.sparkContext.broadcast(gains(*totals))
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    noise = F.floor(-1000 * F.log(-F.log((F.conv(head, 16, 10).cast("double") + 0.5) / 4294967296.0)))
    scored = cut(weigh(docs, shared, longest, buckets).withColumn("score", F.col("weight") + noise))
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    ordered = numbered(scored.where(able), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), into="rank")
    ranked = ordered.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")


def op11_resampling(spark, sf_dir: str) -> DataFrame:
    """All `documents` weighed towards `benchmark`, a tenth of those with 20 words drawn."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: crc32 byte by byte from a table of 256 remainders, once for each different word
OP11_SQL = f"""
WITH RECURSIVE steps(b, c, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM steps WHERE i < 8),
tbl AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8),
low AS (SELECT doc_id, coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS t FROM documents),
source AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM low),
target AS (SELECT unnest(regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
bytes AS (
  SELECT w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT w FROM source UNION SELECT w FROM target)),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM bytes, tbl),
s AS (SELECT bucket, count(*) AS n FROM source JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (w) GROUP BY bucket),
gain AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s)::DOUBLE + {BUCKETS})
         / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t)::DOUBLE + {BUCKETS}))))::BIGINT AS g
  FROM (SELECT DISTINCT bucket FROM hashed) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS weight FROM source JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM low LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= many * {PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
