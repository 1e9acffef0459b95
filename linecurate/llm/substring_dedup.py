"""Repeated passages by sliding runs of consecutive sentences.

Every sentence starts a run: the shortest stretch of consecutive sentences with MIN_SENTENCES and
MIN_WORDS, or with two sentences and LONG_WORDS (so that very long sentences are several enough).
Runs are hashed (128 bits) and matched over all documents; each occurrence but the first marks its sentences, and
marked sentences are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .runtime import bounded_batches, cut, steady_memory

MIN_SENTENCES = 3
MIN_WORDS = 16
LONG_WORDS = 24

_ODD = np.uint64(0xD1342543DE82EF95)
_CLOSES = np.zeros(256, bool)
_CLOSES[list(b".!?")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def sentences(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of words, first byte, past-the-end byte) of the sentences of a text.

    A sentence ends after a word that closes with . ! or ?, before a line feed, and before a
    word with a capital first letter (A-Z, or U+00C0-U+00DE) that follows a word in lower case:
    that is where text was pasted into a sentence. Hashes ignore case (A-Z) and white space.
    """
    starts, ends = tb.word_bounds(raw)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    data = np.frombuffer(raw, np.uint8)
    hashes, _ = tb.word_hashes([raw.translate(tb._LOWER)])
    feeds = np.cumsum(np.concatenate(([0], (data == 10).astype(np.int64))))
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = _CAPITAL[data[starts]] | ((data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
    opens = np.ones(len(starts), bool)
    opens[1:] = _CLOSES[data[ends[:-1] - 1]] | (feeds[starts[1:]] > feeds[ends[:-1]]) | (capital[1:] & ~capital[:-1])
    first = np.flatnonzero(opens)
    words = np.diff(np.concatenate((first, [len(starts)])))
    place = np.arange(len(starts)) - np.repeat(first, words)
    total = np.add.reduceat(tb.mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first)
    return tb.mix(total + words.astype(np.uint64)), words, starts[first], ends[first + words - 1]


def runs(hashes: np.ndarray, words: np.ndarray, least: int, min_words: int, long_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two hashes, first sentence, past-the-end sentence) of the run that starts at each sentence."""
    n = len(hashes)
    upto = np.concatenate(([0], np.cumsum(words)))
    at = np.arange(n)
    by_words = np.searchsorted(upto, upto[:-1] + min_words)
    by_length = np.maximum(np.searchsorted(upto, upto[:-1] + long_words), at + 2)
    end = np.minimum(np.maximum(by_words, at + least), by_length)
    at, end = at[end <= n], end[end <= n]
    value, other = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for step in range(int((end - at).max()) if len(at) else 0):
        on = np.flatnonzero(at + step < end)
        own = hashes[at[on] + step] + np.uint64(step + 1)
        value[on] = tb.mix(value[on] + own)
        other[on] = other[on] * _ODD + tb.mix(own ^ _ODD)
    return value, other, at, end


def _find(least: int, min_words: int, long_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        for batch in batches:
            found = [runs(*sentences((text or "").encode("utf-8", "replace"))[:2], least, min_words, long_words) for text in batch["text"]]
            many = [len(x[0]) for x in found]
            if sum(many):
                value, other, at, end = (np.concatenate(x) for x in zip(*found))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64").repeat(many).array, "t": np.repeat(batch["t"].to_numpy(np.int64), many),
                    "r1": value.view(np.int64), "r2": other.view(np.int64), "at": at.astype(np.int32), "end": end.astype(np.int32),
                })

    return run


def cut_out(text: str, spans: np.ndarray) -> tuple[str, int, int]:
    """The text without these sentences ([first, past the end) pairs, sorted); sentences and words
    removed. What stands between a removed sentence and the next goes too, but for a line feed
    that parts the text kept before from the text kept after."""
    raw = text.encode("utf-8", "replace")
    _, words, first, end = sentences(raw)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, np.minimum(spans[:, 0], len(words)), 1)
    np.add.at(gone, np.minimum(spans[:, 1], len(words)), -1)
    gone = np.cumsum(gone)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(edge[0::2], edge[1::2]):
        out.append(raw[at : first[a]])
        at = first[b] if b < len(first) else len(raw)
        if b"\n" in raw[end[b - 1] : at] and b < len(first) and b"".join(out[-1:]).rstrip(b" \t\r")[-1:] not in (b"\n", b""):
            out.append(b"\n")
    out.append(raw[at:])
    return b"".join(out).decode("utf-8"), int(gone.sum()), int(words[gone].sum())


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        done = [cut_out(t or "", np.array([(s["at"], s["end"]) for s in spans], np.int64).reshape(-1, 2)) for t, spans in zip(batch["text"], batch["spans"])]
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "sentences_removed": [d[1] for d in done], "words_removed": [d[2] for d in done],
            "first_doc_ids": batch["first_doc_ids"], "text": [d[0] for d in done],
        })


def repeated_passages(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """The documents of docs that hold a repeated run, with its sentences taken out of `text`:
    doc_id, sentences_removed, words_removed, first_doc_ids (where the runs come first), text.

    The first occurrence of a run is that with the smallest (doc_id, text's hash, sentence number),
    rows without a doc_id last; it stays, and a document in which nothing goes gives no row. Null,
    empty and short texts have no runs. Rows that repeat a doc_id and its text are one place, so
    only repeats at other places are removed from them; different texts of one doc_id, or of rows
    without one, are different places. Other columns are ignored.

    Two shuffles carry (hash, doc_id, text's hash, place) of every run, pre-aggregated the first
    time; one join carries the texts of the documents to be changed.
    """
    bounded_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), text.alias("text"))
    found = docs.mapInPandas(_find(min_sentences, min_words, long_words), "doc_id long, t long, r1 long, r2 long, at int, end int")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t", "at")
    firsts = found.groupBy("r1", "r2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    firsts = cut(firsts.select("r1", "r2", "first"))
    again = found.join(firsts, ["r1", "r2"]).where(~(place == F.col("first")))
    marks = again.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set(F.struct("at", "end"))).alias("spans"), F.array_sort(F.array_compact(F.collect_set("first.doc_id"))).alias("first_doc_ids"))
    marks = marks.withColumnsRenamed({"doc_id": "__d", "t": "__t"})
    schema = "doc_id long, sentences_removed long, words_removed long, first_doc_ids array<long>, text string"
    changed = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("t") == F.col("__t")))
    return changed.select("doc_id", "text", "spans", "first_doc_ids").mapInPandas(_remove, schema)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The rows of `documents` with repeated passages, each without them."""
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
