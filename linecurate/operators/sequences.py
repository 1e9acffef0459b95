"""Ordered rows: running offsets, batches, runs, gaps, edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import numbered, running_total


def running_offset(df: DataFrame, size: str, order: str, base: int = 0, into: str = "offset") -> DataFrame:
    """Adds base plus the sizes of all rows before by (unique) order."""
    return running_total(df, size, order, into=into).withColumn(into, (F.col(into) + base).cast("long"))


def batches(df: DataFrame, order: str, size: int, into: str = "batch") -> DataFrame:
    """Adds the number, from 0, of each row's batch of `size` rows by (unique) order."""
    return numbered(df, order, into="__rank").withColumn(into, F.floor(F.col("__rank") / size).cast("long")).drop("__rank")


def running_index(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], into: str = "position") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def k_of_n_edges(df: DataFrame, group: str, index: str, active: Column, k: int = 2, n: int = 3) -> DataFrame:
    """(group, first_index, last_index): the first row from which, and the last row up to which, at
    least k of n rows are active; null without one."""
    order = Window.partitionBy(group).orderBy(index)
    flagged = df.withColumn("__a", active.cast("int"))
    ahead, behind = F.sum("__a").over(order.rowsBetween(0, n - 1)), F.sum("__a").over(order.rowsBetween(1 - n, 0))
    framed = flagged.withColumn("__f", ahead).withColumn("__b", behind)
    return framed.groupBy(group).agg(F.min(F.when(F.col("__f") >= k, F.col(index))).alias("first_index"), F.max(F.when(F.col("__b") >= k, F.col(index))).alias("last_index"))


def runs(df: DataFrame, group: str, index: str, flag: Column) -> DataFrame:
    """(group, flag, start, end, length) of the longest stretches of equal flags; index counts from 0 in each group."""
    marked = df.select(group, index, flag.alias("flag"))
    both = Window.partitionBy(group, "flag").orderBy(index)
    island = F.col(index) - F.row_number().over(both)
    return (
        marked.withColumn("__i", island).groupBy(group, "flag", "__i")
        .agg(F.min(index).alias("start"), F.max(index).alias("end"), F.count("*").alias("length")).drop("__i")
    )


def bridged(df: DataFrame, group: str, index: str, flag: Column, most: int = 2) -> DataFrame:
    """(group, index, flag) with inner stretches of up to `most` false rows set true."""
    gaps = runs(df, group, index, flag)
    order = Window.partitionBy(group).orderBy("start")
    inner = F.lag("start").over(order).isNotNull() & F.lead("start").over(order).isNotNull()
    fixed = gaps.withColumn("flag", F.col("flag") | (~F.col("flag") & (F.col("length") <= most) & inner))
    return fixed.select(group, F.explode(F.sequence("start", "end")).alias(index), "flag")


def count_runs(df: DataFrame, group: str, index: str, flag: Column, least: int) -> DataFrame:
    """(group, runs): how many true stretches have at least `least` rows; groups without one are left out."""
    return runs(df, group, index, flag).where(F.col("flag") & (F.col("length") >= least)).groupBy(group).agg(F.count("*").alias("runs"))


def short_islands(df: DataFrame, group: str, index: str, flag: Column, most: int, gap: int) -> DataFrame:
    """(group, start, length, gap_before, gap_after) of true stretches of up to `most` rows with
    false stretches of at least `gap` rows on both sides."""
    order = Window.partitionBy(group).orderBy("start")
    around = runs(df, group, index, flag).withColumn("gap_before", F.lag("length").over(order)).withColumn("gap_after", F.lead("length").over(order))
    return around.where(F.col("flag") & (F.col("length") <= most) & (F.col("gap_before") >= gap) & (F.col("gap_after") >= gap)).select(group, "start", "length", "gap_before", "gap_after")


def first_differences(df: DataFrame, group: str, order: Sequence[str], value: str, into: str = "step") -> DataFrame:
    return df.withColumn(into, F.col(value) - F.lag(value).over(Window.partitionBy(group).orderBy(*order)))
