"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

Each document's MinHash samples are folded into a parity bitmap (an odd sketch): sample j with
value x flips bit hash(j, x). Two sketches differ only where samples differ, so the population
count of their XOR gives the number of differing samples, hence the similarity, most precisely
when that is high. Documents that share a band of samples form a bucket, and buckets with the same
most popular member (the hub) one group. A group is cut into blocks, each with the hub; inside a
block pairs are ranked by sketch, and pairs that no confirmed link joins yet are compared on full
shingle sets. What the links leave outside a group's largest component is then compared with the
group's other blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .components import components
from .runtime import bounded_batches, cut, drop, shuffle_partitions, steady_memory

SKETCH_BITS = 1024
MISS = 1e-6  # chance at most that a pair at the threshold shares no band
BLOCK = 2048  # members of a group that are compared with each other in one place, about
BLOCK_SHINGLES = 4_000_000  # and so many of their shingles, unless a single text has more


class Banding:
    """Numbers of bands and rows for a similarity threshold, with the hash functions."""

    def __init__(self, threshold: float):
        self.rows = 5 if threshold >= 0.85 else 4 if threshold >= 0.6 else 2
        self.bands = math.ceil(math.log(MISS) / math.log(1 - threshold**self.rows))
        self.samples = self.rows * self.bands
        seeds = tb.mix(np.arange(1, 2 * self.samples + 1, dtype=np.uint64))
        self.flip, self.odd = seeds[: self.samples], seeds[self.samples :] | np.uint64(1)
        spread = 5 * math.sqrt(threshold * (1 - threshold) / self.samples)
        differing = self.samples * (1 - max(0.0, threshold - spread))
        #: XOR bits up to which a pair may still reach the threshold (five standard deviations)
        self.most_bits = SKETCH_BITS / 2 * (1 - math.exp(-4 * differing / SKETCH_BITS)) + 5 * math.sqrt(differing) / 2


def _minhashes(values: np.ndarray, starts: np.ndarray, banding: Banding) -> np.ndarray:
    out = np.empty((len(starts), banding.samples), np.uint64)
    for k in range(banding.samples):
        out[:, k] = np.minimum.reduceat((values ^ banding.flip[k]) * banding.odd[k], starts)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (uint8 rows) of MinHash samples (one document a row)."""
    n, k = samples.shape
    at = (tb.mix(samples + np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    counts = np.bincount((at + np.arange(n)[:, None] * SKETCH_BITS).ravel(), minlength=n * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)


def _signatures(width: int, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        banding = Banding(threshold)
        for batch in batches:
            words, counts = tb.word_hashes([tb.lowered(t) for t in batch["text"]])
            ends = np.cumsum(counts)
            sets = [tb.shingles(words[e - c : e], width) for c, e in zip(counts, ends)]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            bands, sketches, prints = [None] * len(sets), [None] * len(sets), np.zeros((len(sets), 2), np.int64)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                values = np.concatenate([sets[i] for i in full])
                samples = _minhashes(values, starts, banding)
                keys = np.zeros((len(full), banding.bands), np.uint64)
                for r in range(banding.rows):
                    keys = tb.mix(keys + samples[:, r :: banding.rows][:, : banding.bands])
                keys = tb.mix(keys + np.arange(banding.bands, dtype=np.uint64)).view(np.int64)
                odd = odd_sketches(samples)
                prints[full, 0] = np.add.reduceat(tb.mix(values), starts).view(np.int64)
                prints[full, 1] = np.bitwise_xor.reduceat(tb.mix(values + np.uint64(77)), starts).view(np.int64)
                for row, i in enumerate(full):
                    bands[i], sketches[i] = keys[row], odd[row].tobytes()
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "t": batch["t"], "n_shingles": sizes, "fp1": prints[:, 0], "fp2": prints[:, 1], "bands": bands, "sketch": sketches})

    return run


def _overlaps(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(many)
    at = np.searchsorted(one, flat)
    at[at == len(one)] = 0
    return np.add.reduceat((one[at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum([len(m) for m in many])[:-1])))


def _link_block(block: pd.DataFrame, width: int, per_mille: int, most_bits: float) -> list[tuple[int, int]]:
    """Links that span the components of one block (cid, comp, asks, answers, minor, n_shingles, sketch, text).

    Rows that ask are compared with rows that answer, a minor one of those only if its cid is
    smaller; pairs that comp or earlier links join already, or that sketch or sizes exclude, are
    passed over.
    """
    block = block.drop_duplicates(["cid", "asks"])
    ids, asks, answers, minor = block["cid"].to_numpy(np.int64), *(block[c].to_numpy(bool) for c in ("asks", "answers", "minor"))
    words, counts = tb.word_hashes([tb.lowered(t) for t in block["text"]])
    ends = np.cumsum(counts)
    sets = [tb.shingles(words[e - c : e], width) for c, e in zip(counts, ends)]
    sizes = np.array([len(s) for s in sets], np.int64)
    bits = np.frombuffer(b"".join(block["sketch"]), np.uint64).reshape(len(ids), -1)
    root, found = np.unique(block["comp"].to_numpy(), return_inverse=True)[1], []
    for i in np.flatnonzero(asks)[np.argsort(ids[asks], kind="stable")]:
        rest = np.flatnonzero(answers & (root != root[i]) & (~minor | (ids < ids[i])) & (1000 * np.minimum(sizes, sizes[i]) >= per_mille * np.maximum(sizes, sizes[i])))
        far = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1)
        rest, far = rest[far <= most_bits], far[far <= most_bits]
        rest = rest[np.lexsort((ids[rest], far))]
        take = 4
        while len(rest):
            now, rest = rest[:take], rest[take:]
            common = _overlaps(sets[i], [sets[j] for j in now])
            for j in now[1000 * common >= per_mille * (sizes[i] + sizes[now] - common)]:
                if root[j] != root[i]:
                    found.append((int(ids[i]), int(ids[j])))
                    root[root == root[j]] = root[i]
            rest, take = rest[root[rest] != root[i]], 64
    return found


def _link(width: int, per_mille: int, most_bits: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steady_memory()
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = held.iloc[-1]
            open_ = (held["hub"] == last["hub"]) & (held["part"] == last["part"]) & (held["block"] == last["block"])
            done, held = held[~open_], held[open_].reset_index(drop=True)
            out = [x for _, g in done.groupby(["hub", "part", "block"], sort=False) for x in _link_block(g, width, per_mille, most_bits)]
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        if held is not None and len(held):
            yield pd.DataFrame(_link_block(held, width, per_mille, most_bits), columns=["u", "v"], dtype="int64")

    return run


_ROW = ("hub", "part", "block", "cid", "comp", "asks", "answers", "minor")


def _blocks(n: Column) -> Column:
    """Blocks for n members (a column of their number, one of all their shingles)."""
    return F.ceil(F.least(n, F.greatest(n / BLOCK, F.col("shingles") / BLOCK_SHINGLES))).cast("int")


def _each(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def _groups(classes: DataFrame) -> DataFrame:
    """(hub, cid, block, blocks): every class that shares a band with others, under each of its bands' hubs.

    A bucket's hub is the member that shares most bands with most classes (the sum of the sizes of
    its buckets). Two classes that share a band are in one group at least. A group's members are
    dealt into blocks by hash; the hub is a member of each.
    """
    posted = classes.select("cid", F.explode("bands").alias("key"))
    shared = cut(posted.join(posted.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"))
    popular = shared.groupBy("cid").agg(F.sum("size").alias("pop"))
    hubs = shared.join(popular, "cid").groupBy("key").agg(F.max(F.struct("pop", "cid"))["cid"].alias("hub"))
    members = shared.select("key", "cid").join(hubs, "key").where("cid <> hub").select("hub", "cid").distinct()
    members = cut(members.join(classes.select("cid", "n_shingles"), "cid"))
    sizes = members.groupBy("hub").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).select("hub", _blocks(F.col("n")).alias("blocks"))
    dealt = members.join(sizes, "hub").select("hub", "cid", F.pmod(F.xxhash64("cid", F.lit(2)), F.col("blocks")).cast("int").alias("block"), "blocks")
    return dealt.union(sizes.select("hub", F.col("hub").alias("cid"), _each(F.col("blocks")).alias("block"), "blocks"))


def _apart(groups: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """Comparisons left in groups of several blocks: each member outside the group's largest
    component (a part of BLOCK of them at a time) against every block. Rows are the members of a
    group once a part, and its outsiders once a block."""
    wide = groups.where("blocks > 1").join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")
    wide = cut(wide.join(sizes, "cid"))
    once = wide.where("cid <> hub or block = 0")
    count = once.groupBy("hub", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    most = count.groupBy("hub").agg(F.max(F.struct("n", "comp"))["comp"].alias("most"), F.sum("n").alias("all"), F.sum("shingles").alias("whole"), F.max(F.struct("n", "comp", "shingles")).alias("top"))
    most = most.select("hub", "most", (F.col("all") - F.col("top.n")).alias("n"), (F.col("whole") - F.col("top.shingles")).alias("shingles")).where("n > 0")
    most = most.select("hub", "most", _blocks(F.col("n")).alias("parts"))
    left = wide.join(most, "hub").withColumn("minor", F.col("comp") != F.col("most"))
    yes, no = F.lit(True), F.lit(False)
    asking = left.where("minor and (cid <> hub or block = 0)").withColumn("part", F.pmod(F.xxhash64("cid", F.lit(4)), F.col("parts")).cast("int")).withColumn("block", _each(F.col("blocks")))
    asking = asking.select("hub", "part", "block", "cid", "comp", yes.alias("asks"), no.alias("answers"), "minor")
    answering = left.where("cid <> hub or block = 0").withColumn("part", _each(F.col("parts"))).select("hub", "part", "block", "cid", "comp", no.alias("asks"), yes.alias("answers"), "minor")
    return asking.union(answering)


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    A document's set has its distinct `width`-word shingles (all its words as one, if fewer).
    Documents whose sets have a Jaccard similarity of `threshold` (taken in thousandths) or more
    are linked; component_id is the smallest doc_id reachable, kept whether that is its own.

    Null, empty and wordless texts have no shingles and are linked with nothing. A row without a
    doc_id is linked with nothing, has a null component_id and is kept. Rows that repeat a doc_id
    are one node, with the links of all its texts (but a wordless one). Of docs only doc_id and text are read; other
    columns, whatever their names, are ignored.

    Copies with equal sets collapse to one class before any comparison. Each class is sent once for
    each hub of its bands, however large its groups are; only what a group's links leave outside its
    largest component is sent again, to the group's blocks. Links are thinned to a spanning forest.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    banding, per_mille = Banding(threshold), round(1000 * threshold)
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"), text.alias("text"))
    signs = cut(docs.mapInPandas(_signatures(width, threshold), "doc_id long, t long, n_shingles long, fp1 long, fp2 long, bands array<long>, sketch binary"))
    named = signs.where("n_shingles > 0 and doc_id is not null")
    same_set = ["fp1", "fp2", "n_shingles"]
    classes = named.groupBy(*same_set).agg(F.min(F.struct("doc_id", "t")).alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = cut(classes.withColumn("cid", F.monotonically_increasing_id()))

    def linked(rows: DataFrame) -> DataFrame:
        wanted = classes.join(rows.select("cid").distinct(), "cid", "left_semi").select("cid", "sketch", F.col("rep.doc_id").alias("doc_id"), F.col("rep.t").alias("t"))
        told = wanted.join(docs, ["doc_id", "t"]).select("cid", "sketch", "text").dropDuplicates(["cid"])
        dealt = rows.join(told, "cid").repartition(max(shuffle_partitions(spark), 8), "hub", "part", "block").sortWithinPartitions("hub", "part", "block")
        return cut(dealt.select(*_ROW, "sketch", "text").mapInPandas(_link(width, per_mille, banding.most_bits), "u long, v long"))

    groups = cut(_groups(classes))
    every = F.lit(True)
    links = linked(groups.select("hub", F.lit(0).alias("part"), "block", "cid", F.col("cid").alias("comp"), every.alias("asks"), every.alias("answers"), every.alias("minor")))
    # a doc_id with several texts is one node
    sets = named.groupBy("doc_id").agg(F.min(F.struct(*same_set)).alias("low"), F.max(F.struct(*same_set)).alias("high")).where("low <> high").select("doc_id", F.col("low").alias("set"))
    named_sets = sets.union(named.join(sets.select("doc_id"), "doc_id", "left_semi").select("doc_id", F.struct(*same_set).alias("set"))).select("doc_id", "set.*")
    texts = named_sets.distinct().join(classes.select("cid", *same_set), same_set).select("doc_id", "cid")
    found = links
    links = links.union(texts.join(texts.groupBy("doc_id").agg(F.min("cid").alias("v")), "doc_id").select(F.col("cid").alias("u"), "v"))
    roots = components(links)
    left = cut(_apart(groups, roots, classes.select("cid", "n_shingles")))
    drop(groups, found)
    if not left.isEmpty():
        found = linked(left)
        roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found))
        drop(found)
    drop(left)

    placed = classes.join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left").select(*same_set, F.col("rep.doc_id").alias("least"), F.coalesce("root", "cid").alias("comp"))
    placed = placed.join(placed.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select(*same_set, "component_id")
    near = named.select("doc_id", *same_set).join(placed, same_set).select("doc_id", "n_shingles", "component_id")
    alone = signs.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return near.union(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near duplicates of `documents`: three-word shingles, similarity of 0.85 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, threshold=0.85)
