"""Toxicity by weak supervision.

Lexicon voters (words) and pattern voters (word beginnings) that go with the label are mined from
a bounded sample of labelled rows. A generative label model then looks at their votes alone: it
estimates how often each voter fires on either class, and, on a maximum spanning tree of the
conditional mutual information, how voters depend on each other. Its posterior labels train a
linear classifier, which scores every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .runtime import bounded_batches, cut

SAMPLE = 20_000  # labelled rows at most that anything is learned from
VOTERS = 128  # best features, which the label model sees
FEATURES = 512
PRECISION = 0.5  # share of class 1 at least among the documents with a feature
WORTH = 11.0  # least evidence (log likelihood) for a feature, above what many tries reach by chance
LEAST = 4  # documents of the sample in which a feature must occur
BEGINNINGS = (4, 5, 6)  # bytes
_OUTER = b".,;:!?\"'()[]{}<>*$%&#@-_/\\+=|~`^"
_CACHE = 200_000
_LONG = 64  # bytes
_RUN = 4  # characters
_CUTS = re.compile(rb"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe3\x80[\x80-\x82]")


def _word_features(word: bytes) -> Iterator[bytes]:
    """The word itself and its beginnings, without outer punctuation; a beginning keeps its length
    in front, so that it differs from a whole word. A word of over _LONG bytes (text without
    blanks) counts by its pieces between punctuation and blanks of all kinds; what is still
    longer by all its runs of _RUN characters."""
    word = word.strip(_OUTER)
    if len(word) <= _LONG:
        if word:
            yield b"=" + word
            yield from (b"%d^%s" % (n, word[:n]) for n in BEGINNINGS if len(word) > n)
        return
    for piece in _CUTS.split(word):
        if len(piece) <= _LONG:
            if piece:
                yield b"=" + piece
                yield from (b"%d^%s" % (n, piece[:n]) for n in BEGINNINGS if len(piece) > n)
        else:
            letters = piece.decode("utf-8", "replace")
            yield from {b"~" + letters[i : i + _RUN].encode() for i in range(len(letters) - _RUN + 1)}


def text_features(text: str | None) -> set[bytes]:
    """All features of a whole text."""
    return {f for w in set(tb.lowered(text).split()) for f in _word_features(w)}


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: dict[bytes, list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"]):
            for f in text_features(text):
                counts.setdefault(f, [0, 0])[int(toxic)] += 1
        yield pd.DataFrame({"feature": list(counts), "n0": [c[0] for c in counts.values()], "n1": [c[1] for c in counts.values()]}).astype({"n0": "int64", "n1": "int64"})


class Lookup:
    """Numbers of the chosen features that a text has."""

    def __init__(self, features: list[bytes]):
        self.number = {f: i for i, f in enumerate(features)}
        self.words: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> list[int]:
        found: set[int] = set()
        words, number = self.words, self.number
        for w in set(tb.lowered(text).split()):
            got = words.get(w)
            if got is None:
                if len(words) >= _CACHE:
                    words.clear()
                got = tuple(number[f] for f in _word_features(w) if f in number)
                if len(w) <= _LONG:
                    words[w] = got
            found.update(got)
        return sorted(found)


def _vote(features: list[bytes]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = Lookup(features)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "t": batch["t"], "found": [look(t) for t in batch["text"]]})

    return run


def _tree(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Parents (-1: none) on the maximum spanning tree of mutual information given the class."""
    n, m = votes.shape
    info = np.zeros((m, m))
    for weight in (q, 1 - q):
        total = weight.sum() + 1e-9
        both = ((votes * weight[:, None].astype(votes.dtype)).T @ votes).astype(np.float64) / total
        own = np.diag(both)
        for a in (0, 1):
            for b in (0, 1):
                p = both if a and b else own[:, None] - both if a else own[None, :] - both if b else 1 - own[:, None] - own[None, :] + both
                pa, pb = (own if a else 1 - own)[:, None], (own if b else 1 - own)[None, :]
                with np.errstate(divide="ignore", invalid="ignore"):
                    term = p * np.log(p / (pa * pb))
                info += total / n * np.where((p > 1e-12) & np.isfinite(term), term, 0)
    np.fill_diagonal(info, -1)
    parent, best, via = np.full(m, -1), np.full(m, -1.0), np.full(m, -1)
    done = np.zeros(m, bool)
    for _ in range(m):
        j = int(np.argmax(np.where(done, -2, best)))
        done[j], parent[j] = True, via[j]
        closer = ~done & (info[j] > np.maximum(best, 1e-4))
        best[closer], via[closer] = info[j][closer], j
    return parent


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def label_model(votes: np.ndarray, prior: float, rounds: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of class 1 for each row, accuracies, parents) from 0/1 votes.

    A voter that fires votes for class 1 and abstains else; one more voter, silence, fires where
    no other does and votes for class 0. An accuracy is the share of class 1 among the rows where
    a voter fires, at least a half (voters are no worse than chance). A voter whose parent on the
    dependency tree fired too adds only the part that is no echo: one less the share of the
    parent's class 1 rows in which it fires. Expectation maximisation starts from belief in any
    vote, and holds the mean posterior at prior, the known share of class 1.
    """
    n, m = votes.shape
    if not m:
        return np.full(n, prior), np.zeros(0), np.zeros(0, np.int64)
    votes, single = votes.astype(np.float32), np.float32  # two such tables at a time
    silent = votes.sum(axis=1) == 0
    q = np.where(silent, 0.01, 0.9)
    parents, accuracy, base = np.full(m, -1), np.full(m, 0.9), np.log(prior / (1 - prior))
    for step in range(rounds):
        if step in (1, 5):
            parents = _tree(votes, q)
        given = votes[:, np.maximum(parents, 0)]
        given[:, parents < 0] = 0
        accuracy = np.clip((q.astype(single) @ votes + 1) / (votes.sum(axis=0) + 2), 0.5, 0.999).astype(np.float64)
        seen = q.astype(single) @ given
        given *= votes  # where a voter and its parent fire both
        echo = (q.astype(single) @ given + 0.5) / (seen + 1)
        weight = np.log(accuracy / (1 - accuracy)) - base
        odds = base + (votes @ weight.astype(single) - given @ (echo * weight).astype(single)).astype(np.float64)
        quiet = np.clip((q[silent].sum() + 0.1) / (silent.sum() + 1), 1e-4, prior)
        odds[silent] = np.log(quiet / (1 - quiet))
        low, high = -20.0, 20.0
        for _ in range(50):
            shift = (low + high) / 2
            low, high = (shift, high) if _sigmoid(odds + shift).mean() < prior else (low, shift)
        q = _sigmoid(odds + shift)
    return q, accuracy, parents


def logistic(x: np.ndarray, q: np.ndarray, penalty: float = 0.05, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier on soft labels, by accelerated gradient steps."""
    n, m = x.shape
    w, b, share = np.zeros(m, np.float32), float(np.log((q.mean() + 1e-6) / (1 - q.mean() + 1e-6))), np.maximum(x.mean(axis=0), 1 / n)
    scale = 1 / (share * 4 + penalty / n)  # steps by how often a feature occurs
    step, ww, bb = 1.0 / max(1.0, x.sum(axis=1).mean()), w.copy(), b
    for k in range(rounds):
        p = _sigmoid(x @ ww.astype(np.float32) + bb)
        gw, gb = x.T @ (p - q).astype(np.float32) / n + penalty * ww / n, float((p - q).mean())
        nw, nb = ww - step * scale * gw, bb - step * gb
        ww, bb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return w, b


def _score(features: list[bytes], weights: np.ndarray, bias: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = Lookup(features)
        for batch in batches:
            batch["score"] = _scores(look, batch["text"], weights, bias)
            yield batch.drop(columns="text").astype({"doc_id": "Int64"})

    return run


def _scores(look: Lookup, texts, weights: np.ndarray, bias: float) -> np.ndarray:
    z = np.array([bias + weights[look(t)].sum() for t in texts], np.float64)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _clean(features: list[bytes], weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(features)
        for batch in batches:
            yield batch.filter(pa.array(_scores(look, batch.column("text").to_pylist(), weights, bias) < 0.5))

    return run


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[bytes], np.ndarray, float]:
    """Features, weights and bias, from at most `sample` labelled rows of docs.

    Labelled rows are taken in order of a hash of doc_id and text, rows that repeat both once;
    those whose crc32(doc_id as text) mod 5 is 0 and those without a label are left out; a doc_id
    that has several labels takes the highest. The sample is checkpointed. The driver gets counts
    of the FEATURES best features and the sample's rows as lists of their numbers, nothing else.
    Without rows of both classes there are no features. The first VOTERS features vote; rows that
    only have others teach the classifier nothing.
    """
    known = labels.where("doc_id is not null and toxic is not null and crc32(cast(cast(doc_id as bigint) as string)) % 5 <> 0")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), "text")
    picked = keyed.select("doc_id", "t").join(F.broadcast(known), "doc_id").distinct().orderBy(F.xxhash64("doc_id", "t"), "doc_id", "t").limit(sample)
    rows = keyed.join(F.broadcast(picked), ["doc_id", "t"]).dropDuplicates(["doc_id", "t"])
    rows = cut(rows.select("doc_id", "t", "text", (F.col("toxic") > 0).cast("int").alias("toxic")))
    n0, n1 = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not n0 or not n1:
        return [], np.zeros(0), -8.0 if not n1 else 8.0
    counts = rows.select("text", "toxic").mapInPandas(_count, "feature binary, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    counts = counts.where(F.col("n0") + F.col("n1") >= LEAST).where(share >= max(PRECISION, 2 * n1 / (n0 + n1)))
    worth = F.col("n1") * F.log(share * (n0 + n1) / n1)
    # whole words and the longest beginnings first among equals
    features = [bytes(r["feature"]) for r in counts.where(worth >= WORTH).orderBy(worth.desc(), F.desc("feature")).limit(FEATURES).collect()]
    got = rows.mapInPandas(_vote(features), "doc_id long, t long, found array<int>").toPandas().sort_values(["doc_id", "t"])["found"].tolist()
    x = np.zeros((len(got), len(features)), np.float32)
    for i, found in enumerate(got):
        x[i, np.asarray(found, np.int64)] = 1
    q, _, _ = label_model(x[:, :VOTERS], min(0.99, n1 / (n0 + n1)))
    # of a row with features of which none is a voter the label model knows nothing
    told = x[:, :VOTERS].any(axis=1) | ~x.any(axis=1)
    weights, bias = logistic(x[told], q[told])
    return features, weights, bias


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    Null and empty texts get the score of a text without features. Rows without a doc_id are
    scored, count as not held out and are never learned from; repeated rows are scored alike.
    An empty labels table, or labels of one class, give one constant score. Of docs only doc_id
    and text are read, of labels only doc_id and toxic.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = docs.mapInPandas(_score(*learn(docs, labels, sample)), "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows of docs, with all columns, that toxicity doesn't predict to be toxic; each row is judged by itself."""
    bounded_batches(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_clean(*learn(known, labels, sample)), docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every row of `documents`."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
