"""Language-model scores of whole texts: a unigram base and a causal self-attention model.

The base counts every training word of the corpus. The model (module attention) reads subword
ids of a public tokenizer: it is started on one shard of the training documents, then every
training document improves it in one of the shards, whose number grows with the corpus, and the
shards' models are averaged, in a tree of tasks.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import attention as at
from . import textblocks as tb
from .runtime import bounded_batches, cut, steady_memory

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # of the query, unless the session names another
TOKENIZER_SETTING = "spark.linecurate.tokenizer"
ITEMS = 1024  # the model's items: most frequent ids, one for all others, one for a text's end
COMMON = 1e-6  # words of this share of all tokens or more are broadcast: 1 / COMMON at most
SHARD_WORDS = 500_000  # words of a shard, about, and of the documents that start the model
MAX_TASKS = 20_000  # tasks that train at most; with more shards each takes several, one after another
START_PASSES = 4
START_RATE, RATE = 2e-2, 8e-3
_MEMO = 600_000
_MEET = 1 << 21
_FLUSH_WORDS, _FLUSH_BYTES = 1 << 19, 1 << 26  # distinct words that a task holds at most, and bytes of texts they come from, about


class _Memo(dict):
    """Numbers (int32 bytes) of a word's subwords, with a blank in front; of long words each 256 characters are
    encoded by themselves. Keeps up to _MEMO words, and those of the texts at hand."""

    def __init__(self, tokens: Tokens):
        self.encoding, self.number, self.lengths, self.passing = tokens.encoding, tokens.number, tokens.lengths, []

    def __missing__(self, word: bytes) -> bytes:
        text = " " + word.decode("utf-8", "replace")
        return self.number[[i for k in range(0, len(text), 256) for i in self.encoding.encode_ordinary(text[k : k + 256])]].tobytes()

    def meet(self, words: Iterable[bytes]) -> None:
        """Encodes the words that aren't known yet in one call, which costs a fraction of a call for each."""
        for word in self.passing:
            del self[word]
        new = [w for w in words if w not in self]
        long, short = [w for w in new if len(w) >= 64], [w for w in new if len(w) < 64]
        room = max(0, _MEMO - len(self))
        self.passing = short[room:] + long
        if short:
            ids = self.encoding.encode_to_numpy(" " + b" ".join(short).decode())
            last = np.cumsum(np.fromiter(map(len, short), np.int64, len(short)) + 1)
            edge = [0, *(np.searchsorted(np.cumsum(self.lengths[ids]), last) + 1).tolist()]
            raw = self.number[ids].tobytes()
            self.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(short, edge, edge[1:]))
        self.update((w, self[w]) for w in long)


class Tokens:
    """Subwords of a text, numbered by falling count (without counts: by id). Built from a tokenizer's file.

    The first `items` numbers are items of the model, all others one item, `items`; the share that
    a number has of that one comes from the counts too, each plus one.
    """

    def __init__(self, ranks: bytes, counts: np.ndarray | None = None):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        # a word and the blank in front are one piece, whatever the word holds, and so is a part of a long word
        self.encoding = tiktoken.Encoding("words", pat_str=r" [^ ]+|[\s\S]+", mergeable_ranks=table, special_tokens={})
        ids = max(table.values()) + 1
        self.lengths = np.zeros(ids, np.int64)
        self.lengths[list(table.values())] = [len(x) for x in table]
        counts = np.zeros(ids, np.int64) if counts is None else counts
        order = np.argsort(-counts, kind="stable")
        self.number = np.empty(ids, np.int32)
        self.number[order] = np.arange(ids, dtype=np.int32)
        self.items = min(ITEMS - 2, max(1, int((counts > 0).sum())))
        rest = counts[order][self.items :] + 1.0
        self.logs = np.concatenate((np.zeros(self.items), np.log(rest / rest.sum())))
        self.memo = _Memo(self)

    def __call__(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.memo.__getitem__, raw.split())), np.int32)

    def all(self, raws: list[bytes]) -> list[np.ndarray]:
        """Each text's numbers. Words are met by _MEET bytes of text."""
        out, i = [], 0
        while i < len(raws):
            j, size = i, 0
            while j < len(raws) and (j == i or size < _MEET):
                size += len(raws[j])
                j += 1
            split = [r.split() for r in raws[i:j]]
            self.memo.meet(set().union(*split))
            out += [np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int32) for words in split]
            i = j
        return out

    def model_items(self, numbers: np.ndarray) -> np.ndarray:
        """The model's items of a text's numbers, then the end."""
        return np.append(np.minimum(numbers, self.items), np.int32(self.items + 1))


_BUILT: dict[bytes, Tokens] = {}


def _tokens(ranks: bytes, counts: np.ndarray | None) -> Tokens:
    """The process's Tokens of these counts, with what it remembers from earlier tasks."""
    key = b"" if counts is None else counts.tobytes()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Tokens(ranks, counts)
    return _BUILT[key]


def score_texts(model: at.Scorer, tokens: Tokens, raws: list[bytes]) -> np.ndarray:
    """log10 probability of each text's subwords and its end."""
    texts = tokens.all(raws)
    total = np.array([tokens.logs[t].sum() for t in texts], np.float64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < 1 << 17):
            size += len(texts[j])
            j += 1
        inputs, targets, owner = at.windows([tokens.model_items(t) for t in texts[i:j]], len(model.own) - 1)
        sums = np.concatenate([model(inputs[a : a + 512], targets[a : a + 512]).sum(axis=1, dtype=np.float64) for a in range(0, len(inputs), 512)])
        total[i:j] += np.bincount(owner, weights=sums, minlength=j - i)
        i = j
    return total / math.log(10)


def _raws(texts) -> list[bytes]:
    return [tb.lowered(t) for t in texts]


def _count(ranks):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        held, size, tokens = Counter(), 0, _tokens(ranks.value, None)
        subwords = np.zeros(len(tokens.number), np.int64)

        def flush() -> pd.DataFrame:
            words, count = list(held), np.fromiter(held.values(), np.int64, len(held))
            held.clear()
            tokens.memo.meet(words)
            parts = [tokens.memo[w] for w in words]
            each = np.repeat(count, np.fromiter(map(len, parts), np.int64, len(parts)) // 4)
            subwords[:] += np.bincount(np.frombuffer(b"".join(parts), np.int32), weights=each, minlength=len(subwords)).astype(np.int64)
            return pd.DataFrame({"kind": 0, "h": tb.word_hashes([b" ".join(words)])[0].view(np.int64), "c": count})

        for batch in batches:
            for raw in _raws(batch["text"]):
                held.update(raw.split())
                size += len(raw)
            if len(held) >= _FLUSH_WORDS or size >= _FLUSH_BYTES:
                yield flush()
                size = 0
        yield flush()
        seen = np.flatnonzero(subwords)
        yield pd.DataFrame({"kind": 1, "h": seen, "c": subwords[seen]})

    return run


def _shards(batches: Iterator[pd.DataFrame], tokens: Tokens) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row's key, texts as items) of each shard, which follow each other; of a shard in parts only
    where very many rows are equal or texts are very long."""
    key, held, size, now = None, [], 0, None
    for batch in batches:
        for own, shard, numbers in zip(batch["key"], batch["shard"], tokens.all(_raws(batch["text"]))):
            if held and shard != now:
                yield key, held
                key, held, size = None, [], 0
            now, key = shard, int(own) if key is None else key
            held.append(tokens.model_items(numbers))
            size += len(held[-1])
            if size > 16 * SHARD_WORDS:
                yield key, held
                key, held, size = None, [], 0
    if held:
        yield key, held


def _start(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        tokens, model = _tokens(*shared.value), None
        for _, texts in _shards(batches, tokens):
            seen = np.bincount(np.concatenate(texts), minlength=tokens.items + 2)
            model = at.Model.fresh(seen) if model is None else model
            inputs, targets, _ = at.windows(texts, model.size)
            model = at.train(model, inputs, targets, max(START_PASSES, 20 * at.RUN * at.RUNS / len(inputs)), START_RATE)
        if model is not None:
            yield pd.DataFrame({"model": [model.to_bytes()]})

    return run


def _improve(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        ranks, counts, start = shared.value
        tokens = _tokens(ranks, counts)
        for key, texts in _shards(batches, tokens):
            inputs, targets, _ = at.windows(texts, start.size)
            yield pd.DataFrame({"key": [key], "n": [len(inputs)], "model": [at.train(start, inputs, targets, 1, RATE).to_bytes()]})

    return run


def _average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n, first = None, 0, None
    for batch in batches:
        for key, k, raw in zip(batch["key"], batch["n"], batch["model"]):
            own = np.frombuffer(raw, np.float32) * np.float64(k)
            total, n = own if total is None else total + own, n + int(k)
            first = key if first is None else first
    if n:
        yield pd.DataFrame({"key": [first], "n": [n], "model": [(total / n).astype(np.float32).tobytes()]})


def train_model(training: DataFrame, words: int, ranks: bytes, counts: np.ndarray) -> at.Model:
    """The model learned from training (doc_id, text) of so many words, whose subwords have these counts.

    The same two steps at every size: documents of about SHARD_WORDS words (one at least), chosen
    by a hash of doc_id and text, start the model; then all training documents, those too, are
    dealt by another hash into shards of about SHARD_WORDS words, and each shard goes on from the
    start in one pass over all of its windows. Up to MAX_TASKS tasks take the shards. What is gathered is one model (of fixed size) a
    shard, weighted by windows and averaged 16 to 1 by tasks until one is left. Rows are sorted
    before they are learned from, and models before they are added up, so that reruns agree.
    """
    spark = training.sparkSession
    tokens = Tokens(ranks, counts)
    like = at.Model.fresh(np.ones(tokens.items + 2))
    row = training.select("doc_id", "text", F.xxhash64("doc_id", "text", F.lit(6)).alias("key"))
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    least = training.agg(F.min(draw)).first()[0]
    if least is None:
        return like
    first = max(least, SHARD_WORDS / max(1, words))
    order = ("key", "doc_id", "text")
    shared = spark.sparkContext.broadcast((ranks, counts))
    got = row.where(draw <= first).repartition(1).sortWithinPartitions(*order).select("key", F.lit(0).alias("shard"), "text").mapInPandas(_start(shared), "model binary").collect()[0]
    start = at.Model.from_bytes(got["model"], like)
    shards = max(1, math.ceil(words / SHARD_WORDS))
    shared = spark.sparkContext.broadcast((ranks, counts, start))
    schema = "key long, n long, model binary"
    each = math.ceil(shards / MAX_TASKS)
    tasks = math.ceil(shards / each)
    dealt = row.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(each))).repartition(tasks, "key").sortWithinPartitions("shard", *order)
    models = dealt.select("key", "shard", "text").mapInPandas(_improve(shared), schema)
    while True:
        shards = math.ceil(shards / 16)
        models = models.repartition(shards, "key").sortWithinPartitions("key", "n", "model").mapInPandas(_average, schema)
        if shards == 1:
            return at.Model.from_bytes(models.collect()[0]["model"], like)


def _score(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        ranks, subwords, model, common, logs = shared.value
        tokens, scorer = _tokens(ranks, subwords), at.Scorer(model)
        for batch in batches:
            raws = _raws(batch["text"])
            words, counts = tb.word_hashes(raws)
            slot = np.minimum(np.searchsorted(common, words), max(0, len(common) - 1))
            known = common[slot] == words if len(common) else np.zeros(len(words), bool)
            edge = np.concatenate(([0], np.cumsum(counts)))
            value = np.concatenate(([0.0], np.cumsum(np.where(known, logs[slot], 0.0)))) if len(common) else np.zeros(len(words) + 1)
            upto = np.concatenate(([0], np.cumsum(known)))
            rest, many = [], []
            for a, b in zip(edge[:-1], edge[1:]):
                h, c = np.unique(words[a:b][~known[a:b]], return_counts=True)
                rest.append(h.view(np.int64))
                many.append(c.astype(np.int32))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_words": counts, "common_sum": value[edge[1:]] - value[edge[:-1]], "common_known": (upto[edge[1:]] - upto[edge[:-1]]).astype(np.int64),
                "score": score_texts(scorer, tokens, raws), "rest": rest, "many": many,
            })

    return run


def lm_scores(docs: DataFrame, tokenizer: str, held_out: int = 2, folds: int = 7) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32(doc_id as text) mod folds isn't held_out. Tokens are
    words after lower-casing A-Z, and one end a text; base_score is their add-one unigram log10
    probability. score is the attention model's log10 probability of the subwords of the same
    words, and the end; tokenizer is the file of the subwords (base64 bytes and their rank on each
    line), read on the driver. Subwords that aren't among the model's items are told apart by their
    counts in the training documents. A null text is empty: its only token is the end. Rows without a doc_id
    are scored, but neither learned from nor held out; repeated rows are counted and scored each.
    Without training documents the base is 0 and the model knows one item. Other columns are
    ignored. Words are counted by 64-bit hashes.

    Counts of common words (1 / COMMON at most) are broadcast, those of the rest are joined with
    the rest's distinct words of each document.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    training = docs.where(fold != held_out)
    with open(tokenizer, "rb") as file:
        ranks = file.read()
    counted = cut(training.mapInPandas(_count(spark.sparkContext.broadcast(ranks)), "kind int, h long, c long").groupBy("kind", "h").agg(F.sum("c").alias("c")))
    counts = counted.where("kind = 0").select("h", "c")
    ends = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total = words + ends
    space = total + distinct + (1 if ends else 0) + 1
    least = max(1.0, COMMON * total)
    frequent = counts.where(F.col("c") >= least).toPandas()
    hashes = frequent["h"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(hashes)
    common, logs = hashes[by], np.log10(frequent["c"].to_numpy(np.float64)[by] + 1)
    ids = counted.where("kind = 1").toPandas()  # as many rows as the tokenizer has ids, at most
    subwords = np.zeros(len(Tokens(ranks).number), np.int64)
    subwords[ids["h"].to_numpy(np.int64)] = ids["c"].to_numpy(np.int64)
    model = train_model(training, words, ranks, subwords)
    shared = spark.sparkContext.broadcast((ranks, subwords, model, common, logs))
    schema = "doc_id long, n_words long, common_sum double, common_known long, score double, rest array<long>, many array<int>"
    scored = cut(docs.mapInPandas(_score(shared), schema).withColumn("row", F.monotonically_increasing_id()))
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "many")).alias("x")).select("row", F.col("x.rest").alias("h"), F.col("x.many").alias("many"))
    joined = rest.join(counts.where(F.col("c") < least), "h")
    sums = joined.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1.0) * F.col("many")).alias("rest_sum"), F.sum("many").alias("rest_known"))
    end = math.log10(ends + 1)
    return scored.drop("rest", "many").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out, F.lit(False)).alias("held_out"),
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("common_known") + F.coalesce("rest_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common_sum") + F.coalesce("rest_sum", F.lit(0.0)) + end - (F.col("n_words") + 1) * math.log10(space)).alias("base_score"),
        "score",
    )


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Language-model scores of all `documents`."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.conf.get(TOKENIZER_SETTING, TOKENIZER))
