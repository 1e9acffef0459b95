"""Ordered rows of series of any length: what sequences does by a window a group, by segments of equal size.

Rows get their place in the order of group and index, and each segment of consecutive places
also the rows just before and behind it. A window with a bounded frame is then the same inside
its segment, though one series may be spread over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import numbered, placed_in_order


def segments(df: DataFrame, *order: str, halo: int = 1, pieces: int | None = None) -> DataFrame:
    """df with __place, __segment (of about rows / pieces rows, at least halo) and __own: false for the halo rows that a segment gets from its neighbours."""
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = numbered(df, *order, into="__place", pieces=pieces)
    size = max(halo, 1, -(-placed.count() // pieces))
    place = F.col("__place")
    home, inside = F.floor(place / size), place % size
    around = F.array_compact(F.array(F.struct(home.alias("s"), F.lit(True).alias("own")), F.when(inside < halo, F.struct((home - 1).alias("s"), F.lit(False).alias("own"))), F.when(inside >= size - halo, F.struct((home + 1).alias("s"), F.lit(False).alias("own")))))
    return placed.withColumn("__x", F.explode(around)).select(*placed.columns, F.col("__x.s").alias("__segment"), F.col("__x.own").alias("__own"))


def _inside(group: str):
    return Window.partitionBy("__segment", group).orderBy("__place")


def first_differences(df: DataFrame, group: str, order: str, value: str, into: str = "step", pieces: int | None = None) -> DataFrame:
    cut = segments(df, group, order, pieces=pieces)
    return cut.withColumn(into, F.col(value) - F.lag(value).over(_inside(group))).where("__own").drop("__place", "__segment", "__own")


def k_of_n_edges(df: DataFrame, group: str, index: str, active: Column, k: int = 2, n: int = 3, pieces: int | None = None) -> DataFrame:
    """As sequences.k_of_n_edges."""
    cut = segments(df.select(group, index, active.cast("int").alias("__a")), group, index, halo=n - 1, pieces=pieces)
    order = _inside(group)
    framed = cut.withColumn("__f", F.sum("__a").over(order.rowsBetween(0, n - 1))).withColumn("__b", F.sum("__a").over(order.rowsBetween(1 - n, 0))).where("__own")
    return framed.groupBy(group).agg(F.min(F.when(F.col("__f") >= k, F.col(index))).alias("first_index"), F.max(F.when(F.col("__b") >= k, F.col(index))).alias("last_index"))


def runs(df: DataFrame, group: str, index: str, flag: Column, pieces: int | None = None) -> DataFrame:
    """(group, flag, start, end, length) of the longest stretches of neighbouring rows with equal flags.

    Each row knows from the one before whether it begins a run; runs are numbered by a prefix sum
    and added up, in part before they are shuffled.
    """
    cut = segments(df.select(group, index, flag.alias("flag")), group, index, pieces=pieces)
    begins = ~F.lag(F.struct("flag")).over(_inside(group)).eqNullSafe(F.struct("flag"))
    begun = cut.withColumn("__b", begins.cast("long")).where("__own").select(group, index, "flag", "__place", "__b")
    named = placed_in_order(begun, "__b", "__place", total_into="__run", pieces=pieces).withColumn("__run", F.col("__run") + F.col("__b"))
    return named.groupBy("__run").agg(F.first(group).alias(group), F.first("flag").alias("flag"), F.min(index).alias("start"), F.max(index).alias("end"), F.count("*").alias("length")).drop("__run")


def bridged(df: DataFrame, group: str, index: str, flag: Column, most: int = 2, pieces: int | None = None) -> DataFrame:
    """As sequences.bridged, for an index that counts up by one."""
    cut = segments(runs(df, group, index, flag, pieces), group, "start", pieces=pieces)
    order = _inside(group)
    inner = F.lag("start").over(order).isNotNull() & F.lead("start").over(order).isNotNull()
    fixed = cut.withColumn("__inner", inner).where("__own").withColumn("flag", F.col("flag") | (~F.col("flag") & (F.col("length") <= most) & F.col("__inner")))
    return fixed.select(group, F.explode(F.sequence("start", "end")).alias(index), "flag")


def count_runs(df: DataFrame, group: str, index: str, flag: Column, least: int, pieces: int | None = None) -> DataFrame:
    """As sequences.count_runs."""
    return runs(df, group, index, flag, pieces).where(F.col("flag") & (F.col("length") >= least)).groupBy(group).agg(F.count("*").alias("runs"))


def short_islands(df: DataFrame, group: str, index: str, flag: Column, most: int, gap: int, pieces: int | None = None) -> DataFrame:
    """As sequences.short_islands."""
    cut = segments(runs(df, group, index, flag, pieces), group, "start", pieces=pieces)
    order = _inside(group)
    around = cut.withColumn("gap_before", F.lag("length").over(order)).withColumn("gap_after", F.lead("length").over(order)).where("__own")
    return around.where(F.col("flag") & (F.col("length") <= most) & (F.col("gap_before") >= gap) & (F.col("gap_after") >= gap)).select(group, "start", "length", "gap_before", "gap_after")
