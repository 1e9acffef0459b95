"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A text of n bytes within k edits of another shares at least n - Q + 1 - k*Q of its q-grams with
it, all on diagonals at most k apart. (Where that is none, one of k + 1 pieces is free of edits, and
these are looked up instead.) So shared q-grams are counted in overlapping diagonal
bands; only stretches that reach this bound are aligned, and only alignments within the edit
budget count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .runtime import bounded_batches, cut

Q = 12
WINDOW = 96  # bytes of an item that count as a passage; shorter items count whole
EDITS = 0.05  # edits allowed for each byte of the passage
BLOCK_BYTES = 4 << 20  # of benchmark text that one pass over the documents looks for
PIECE = 10  # bytes of each half by which items are found that one edit can rob of all their q-grams
_TABLE_BITS = 22
_HITS = 1 << 22  # shared q-grams that are held at a time


def normal(text: str | None) -> bytes:
    """Lower-cased bytes with each run of white space turned into one blank."""
    return b" ".join(tb.lowered(text).split())


def _grams(raw: bytes, q: int = Q) -> np.ndarray:
    """Hashes of all runs of q bytes (10 or 12)."""
    if len(raw) < q:
        return np.zeros(0, np.uint64)
    buffer = np.frombuffer(raw, np.uint8)
    first = np.ndarray((len(raw) - q + 1,), "<u8", buffer, strides=(1,))
    last = np.ndarray((len(raw) - q + 1,), f"<u{q - 8}", buffer, offset=8, strides=(1,))
    return first * np.uint64(0x9E3779B97F4A7C15) + tb.mix(last.astype(np.uint64))


def _bound(size: int) -> int:
    """Q-grams that a passage of an item of this size shares at least, whatever edits are allowed for it."""
    n = min(size, WINDOW)
    return n - Q + 1 - int(EDITS * n) * Q


class Index:
    """Q-grams of a block of benchmark items, sorted, with a bit table in front. Items with the same
    text are looked for once; those of fewer than Q bytes are kept aside, whole."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        owners: dict[bytes, list[int]] = {}
        for i, t in zip(ids, texts):
            owners.setdefault(t, []).append(i)
        self.short = {t: o for t, o in owners.items() if 0 < len(t) < Q}
        texts = [t for t in owners if len(t) >= Q]
        self.ids, self.texts = [owners[t] for t in texts], texts
        grams = [_grams(t) for t in texts]
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.grams = flat[order]
        self.items = np.repeat(np.arange(len(texts)), [len(g) for g in grams])[order]
        self.at = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])[order].astype(np.int64)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self._slot(flat)] = True
        # one of two halves is free of a single edit
        loose = [i for i, t in enumerate(texts) if int(EDITS * len(t)) and _bound(len(t)) < 1]
        self.pieces: dict[int, list[tuple[int, int]]] = {}
        for i in loose:
            for at in (0, len(texts[i]) - PIECE):
                self.pieces.setdefault(int(_grams(texts[i][at : at + PIECE], PIECE)[0]), []).append((i, at))
        self.piece_grams = np.array(sorted(self.pieces), np.uint64)

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _TABLE_BITS)

    def shared(self, raw: bytes, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document offset, first posting, number of postings) of the q-grams shared by raw[start:end]."""
        grams = _grams(raw[start : end + Q - 1])
        at = np.flatnonzero(self.table[self._slot(grams)])
        low, high = np.searchsorted(self.grams, grams[at], "left"), np.searchsorted(self.grams, grams[at], "right")
        on = high > low
        return at[on] + start, low[on], (high - low)[on]

    def hits(self, at: np.ndarray, low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, item offset, document offset) of these postings."""
        where = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return self.items[where], self.at[where], np.repeat(at, many)


def edits_within(pattern: bytes, text: bytes, budget: int) -> tuple[int, int] | None:
    """Fewest edits of pattern against any part of text, and that part's end; None above budget.

    text is expected to hold the part at an offset of at most 2 * budget: only a band of
    4 * budget + 1 diagonals is filled.
    """
    width = 4 * budget + 1
    lanes = np.arange(width)
    p, t = np.frombuffer(pattern, np.uint8), np.frombuffer(text, np.uint8)
    padded = np.full(len(p) + 2 * width + len(t), 256, np.int32)
    padded[:len(t)] = t
    big = 1 << 20
    # lane c of row i stands for i pattern bytes against a part that ends at text byte i + c - budget
    row = np.where(lanes >= budget, 0, big)
    for i in range(1, len(p) + 1):
        ends = i + lanes - budget
        fit = np.where((ends >= 1) & (ends <= len(t)), padded[np.maximum(ends - 1, 0)] == p[i - 1], False)
        best = np.where((ends >= 1) & (ends <= len(t)), row + ~fit, big)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best[ends < 0] = big
        best[ends > len(t)] = big
        row = np.minimum(best, np.minimum.accumulate(best - lanes) + lanes)
        if row.min() > budget:
            return None
    c = int(row.argmin())
    return int(row[c]), len(p) + c - budget


def _stretches(at: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Starts of the item's windows that hold enough q-gram hits (at: their sorted item offsets),
    those with most hits first; windows that overlap come together."""
    n, need = min(size, WINDOW), max(1, _bound(size))
    if len(at) < need:
        return
    # a window holds hits i to i + need - 1 if it starts between these
    low, high = np.maximum(at[need - 1 :] - (n - Q), 0), np.minimum(at[: len(at) - need + 1], size - n)
    opens = np.zeros(size + 2, np.int64)
    np.add.at(opens, low[low <= high], 1)
    np.add.at(opens, high[low <= high] + 1, -1)
    starts = np.flatnonzero(np.cumsum(opens) > 0)
    for part in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
        if len(part):
            hits = np.searchsorted(at, part + n - Q, "right") - np.searchsorted(at, part, "left")
            yield part[np.argsort(-hits, kind="stable")]


def _pieces(raw: bytes, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hits of raw in pieces that overlap by two windows, so that no stretch is cut in two; a piece has
    at most _HITS of them, unless so many share a few windows."""
    step, last = 1 << 20, len(raw) - Q + 1
    for start in range(0, max(1, last), step):
        todo = [(max(0, start - 2 * WINDOW), min(start + step, last))]
        while todo:
            a, b = todo.pop()
            at, low, many = index.shared(raw, a, b)
            if many.sum() > _HITS and b - a > 8 * WINDOW:
                middle = (a + b) // 2
                todo += [(middle - 2 * WINDOW, b), (a, middle)]
            elif len(at):
                yield index.hits(at, low, many)


def passages(raw: bytes, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(item number, first and past-the-end byte in raw, bytes of the item matched, edits), in order.

    Verified stretches of an item that share half of their bytes in raw or more are one passage, of
    which the stretch with the fewest edits, then the longest, is given.
    """
    found: set[tuple[int, int, int, int, int]] = set()
    for items, at, where in _pieces(raw, index):
        budget = np.maximum(1, (EDITS * np.minimum(index.sizes[items], WINDOW)).astype(np.int64))
        band = (where - at) // budget
        items, at, where, band = (np.concatenate((x, x)) for x in (items, at, where, band))
        band[len(band) // 2 :] -= 1
        order = np.lexsort((at, band, items))
        items, at, where, band = items[order], at[order], where[order], band[order]
        edge = np.flatnonzero((np.diff(items) != 0) | (np.diff(band) != 0)) + 1
        for low, high in zip(np.concatenate(([0], edge)), np.concatenate((edge, [len(items)]))):
            item = int(items[low])
            size, own = len(index.texts[item]), int(max(1, EDITS * min(len(index.texts[item]), WINDOW)))
            if high - low < _bound(size):
                continue
            for starts in _stretches(np.unique(at[low:high]), size):
                found.update((item, *got) for got in _verify(raw, index.texts[item], int(band[low]) * own, starts, own))
    if len(index.piece_grams):
        for start in range(0, max(1, len(raw) - PIECE + 1), 1 << 20):
            grams = _grams(raw[start : start + (1 << 20) + PIECE - 1], PIECE)
            place = np.searchsorted(index.piece_grams, grams)
            place[place == len(index.piece_grams)] = 0
            for where in np.flatnonzero(index.piece_grams[place] == grams):
                for item, at in index.pieces[int(grams[where])]:
                    found.update((item, *got) for got in _verify(raw, index.texts[item], start + int(where) - at, np.zeros(1, np.int64), 1))
    kept: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for x in sorted(found, key=lambda x: (x[0], x[4], -x[3], x[1])):
        own = kept.setdefault(x[0], [])
        if all(2 * (min(x[2], y[2]) - max(x[1], y[1])) < min(x[2] - x[1], y[2] - y[1]) for y in own):
            own.append(x)
    return sorted(x for own in kept.values() for x in own)


def _verify(raw: bytes, item: bytes, base: int, starts: np.ndarray, budget: int) -> Iterator[tuple[int, int, int, int]]:
    """Aligns the stretch that these windows cover; if that fails, one window after another, but for
    those that overlap one found before."""
    n = min(len(item), WINDOW)

    def aligned(x: int, y: int) -> tuple[int, int, int, int] | None:
        allowed = max(budget, int(EDITS * (y - x)))
        start = max(0, base + x - allowed)
        text = raw[start : max(0, base + y + 3 * allowed)]
        exact = text.find(item[x:y])
        got = (0, exact + y - x) if exact >= 0 else edits_within(item[x:y], text, allowed)
        if got and got[0] <= int(EDITS * (y - x)):
            return max(0, start + got[1] - (y - x)), start + got[1], y - x, got[0]
        return None

    whole = (int(starts.min()), int(starts.max()) + n)
    if got := aligned(*whole):
        yield got
    elif whole[1] - whole[0] > n:
        done: list[int] = []
        for x in map(int, starts):
            if all(abs(x - y) >= n for y in done) and (got := aligned(x, x + n)):
                done.append(x)
                yield got


def _finds(text: str | None, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(item_id, first word, past-the-end word, matched bytes, edits) of a whole text."""
    raw = normal(text)
    for item_id in index.short.get(raw, ()):
        yield item_id, 0, raw.count(b" ") + 1, len(raw), 0
    for item, start, end, matched, edits in passages(raw, index):
        first = raw.count(b" ", 0, start)
        for item_id in index.ids[item]:
            yield item_id, first, first + raw.count(b" ", start, end) + 1, matched, edits


def _search(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            out = [(doc_id, *x) for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]) for x in _finds(text, index)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "first_word", "end_word", "matched_bytes", "edits"]).astype({"doc_id": "Int64", "item_id": "int64"})

    return run


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            yield batch.filter(pa.array([next(_finds(t, index), None) is None for t in batch.column("text").to_pylist()], pa.bool_()))

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of benchmark items in docs: doc_id, item_id, first_word, end_word, matched_bytes, edits.

    A passage is a whole item of fewer than WINDOW bytes, or any WINDOW bytes of a longer one,
    found within EDITS edits a byte; an item of fewer than Q bytes must be the whole document. Case
    (A-Z) and the kind and amount of white space don't count. A document without passages gives
    no row; one with several gives several, one row each. Null or empty texts and items match
    nothing, as do null item ids; null doc_ids are carried along; repeated rows are searched again.
    Columns other than doc_id, text, item_id are ignored.

    The benchmark is the stated query set. It goes to the executors in blocks of BLOCK_BYTES, each
    of which costs one pass over docs. The driver holds one block at a time: with several, each
    one's finds are checkpointed and its broadcast is given up before the next.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_word long, end_word long, matched_bytes long, edits long"
    out = None
    for index, last in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)
        part = source.mapInPandas(_search(shared), schema)
        if not last or out is not None:
            part = cut(part)
            shared.unpersist()
        out = part if out is None else out.union(part)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs, with all columns, in which contaminated finds no passage; each row is judged by itself."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    for index, last in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)
        docs = docs.mapInArrow(_clean(shared), docs.schema)
        if not last:
            docs = cut(docs)
            shared.unpersist()
    return docs


def _blocks(benchmark: DataFrame) -> Iterator[tuple[Index, bool]]:
    """Indexes of the benchmark's items, BLOCK_BYTES each, and whether it is the last; one at least."""
    wanted = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids, texts, size = [], [], 0
    for row in wanted.distinct().toLocalIterator():
        if size >= BLOCK_BYTES:
            yield Index(ids, texts), False
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(normal(row["text"]))
        size += len(texts[-1])
    yield Index(ids, texts), True


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every passage of `benchmark` in `documents`."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
