"""Mixing sources to target weights by systematic sampling.

Within a source every document gets an expected number of copies. These are prefix-summed over
the source, one random offset is added, and a document is emitted once for each integer boundary
that its own stretch of the sum crosses. Documents are put in order of size, so the words taken
from any stretch of similar sizes come near their share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
UNIT = 1 << 24  # expected copies are summed as whole multiples of 1/UNIT, exact in any order
CELL_ROWS = 50_000  # rows that one window group gets, about
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds `target` to one row a source (source, source_size).

    Sources in code point order, null last, weigh `weights`, repeating. They split `share` times
    the sum of sizes; nobody gets above `cap` times its size, and the excess is shared again by
    weight. That is the level L with sum(min(cap * size, L * weight)) = share * total, found with
    two running sums over the sources in order of size by weight. One row a source, whose number
    must fit one task's windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    out = (
        sizes.withColumn("weight", weight)
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("below", F.coalesce(F.sum("source_size").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap)
        .withColumn("open", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("below")) / F.col("open"))
    )
    # a source is full if it is so at the level that holds when all before it are full
    out = out.withColumn("full", F.col("level") * F.col("weight") >= F.col("source_size") * cap)
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return out.select("source", "source_size", F.when(F.col("full"), F.col("source_size") * cap).otherwise(level * F.col("weight")).alias("target"))


def systematic(rows: DataFrame, group: str, order: Sequence[Column], expected: Column, seed: int = 7) -> DataFrame:
    """Adds `copies`, drawn by systematic sampling within each value of `group` (null is one too).

    `order` gives a cell number (a long, from few values) and then the order within a cell. Prefix
    sums are two-level: cells are cut into pieces of about CELL_ROWS rows, whose totals are summed
    over the group, and rows are summed within their piece. The offset is a hash of seed and group,
    so reruns agree; ties in the order are broken by all of `order`, and equal rows get their
    copies in turn.
    """
    cell, *rest = order
    rows = rows.withColumn("__cell", cell).withColumn("__units", F.greatest(F.lit(0), F.round(expected * UNIT)).cast("long"))
    sizes = rows.groupBy(group, "__cell").agg(F.count("*").alias("__n"))
    mostly = sizes.withColumn("__pieces", F.ceil(F.col("__n") / CELL_ROWS)).select(F.col(group).alias("__g"), F.col("__cell").alias("__c"), "__pieces")
    rows = rows.join(mostly, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__cell") == F.col("__c"))).drop("__g", "__c")
    rows = rows.withColumn("__piece", F.pmod(F.xxhash64(F.lit(seed), *rest), F.col("__pieces"))).drop("__pieces")
    totals = rows.groupBy(group, "__cell", "__piece").agg(F.sum("__units").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.partitionBy(group).orderBy("__cell", "__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col(group)), F.lit(UNIT))
    totals = totals.select(F.col(group).alias("__g"), F.col("__cell").alias("__c"), F.col("__piece").alias("__p"), (before + offset).alias("__before"))
    rows = rows.join(totals, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__cell") == F.col("__c")) & (F.col("__piece") == F.col("__p")))
    within = Window.partitionBy("__g", "__c", "__p").orderBy(*rest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__to", F.col("__before") + F.sum("__units").over(within))
    copies = F.expr(f"(__to div {UNIT}) - ((__to - __units) div {UNIT})")
    return rows.withColumn("copies", copies).drop("__cell", "__units", "__g", "__c", "__p", "__piece", "__before", "__to")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, source, size, source_size, target, copies, taken, and keys.

    size is the text's number of words (null: 0), taken what the mix takes of it, repeats counted
    (at most ceil(cap) times size). Every document of a source has the same expectation,
    target / source_size; a source without words takes none. Null sources form a source of their
    own, in last place. Rows that repeat a doc_id are drawn each for itself. An empty table gives
    an empty result. Columns other than doc_id, source, text and keys are ignored; keys also break ties
    of the order. Checkpoints one
    narrow row a document (no text).
    """
    size = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(_WORD))).cast("long")
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), *keys))
    aims = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    aims = aims.select(F.col("source").alias("__s"), "source_size", "target")
    rows = sized.join(F.broadcast(aims), F.col("source").eqNullSafe(F.col("__s"))).drop("__s") if aims.count() <= 100_000 else sized.join(aims, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    by_size = F.floor(F.log2(F.col("size") + 1.0) * 8).cast("long")
    drawn = systematic(rows, "source", [by_size, F.col("size"), F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id"), *map(F.col, keys)], expected, seed)
    return drawn.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keys)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """All `documents` mixed: 150 % of all words, source weights 3, 1, 2, at most twice a source."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
