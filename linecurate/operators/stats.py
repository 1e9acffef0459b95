"""Order statistics, percentiles and robust scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import SMALL, quantiles
from .scan import held, running_total


def distinct_cdf(df: DataFrame, value: str) -> DataFrame:
    """(value, __upto, __all): how many rows lie at or below each distinct value, and how many there are."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__n"))
    summed = running_total(counts, "__n", value, into="__below")
    total = counts.agg(F.sum("__n").alias("__all"))
    return summed.select(value, (F.col("__below") + F.col("__n")).alias("__upto")).join(F.broadcast(total))


def ecdf(df: DataFrame, value: str, into: str = "percentile") -> DataFrame:
    """Adds the share in percent of rows whose value is no larger (nulls aside, and null for them)."""
    cdf = distinct_cdf(df, value).select(F.col(value).alias("__v"), (100.0 * F.col("__upto") / F.col("__all")).alias(into))
    return df.join(cdf, F.col(value) == F.col("__v"), "left").drop("__v")


def ecdf_against(df: DataFrame, value: str, baseline: DataFrame, baseline_value: str, into: str = "percentile") -> DataFrame:
    """Adds the share in percent of the baseline's values that are no larger.

    Values of both sides are merged in order, with the baseline's counted 1; equal values take the
    baseline's first. Missing baseline values don't count; without any the share is null.
    """
    base = baseline.where(F.col(baseline_value).isNotNull()).groupBy(F.col(baseline_value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    asked = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("__v"), F.lit(0).cast("long").alias("__n")).distinct()
    merged = base.unionByName(asked).groupBy("__v").agg(F.sum("__n").alias("__n"))
    summed = running_total(merged, "__n", "__v", into="__below")
    total = base.agg(F.sum("__n").alias("__all"))
    share = summed.join(F.broadcast(total)).select("__v", (100.0 * (F.col("__below") + F.col("__n")) / F.col("__all")).alias(into))
    return df.join(share, F.col(value).cast("double") == F.col("__v"), "left").drop("__v")


def robust_z(df: DataFrame, value: str, into: str = "z") -> DataFrame:
    """Adds 0.6745 * (x - median) / MAD; (x - median) / standard deviation if the MAD is 0, else 0."""
    middle = quantiles(df, value, [0.5], small=SMALL).select(F.col("quantiles")[0].alias("__m")).crossJoin(df.agg(F.stddev_pop(value).alias("__s")))
    apart = df.select(value).crossJoin(F.broadcast(middle)).select(F.abs(F.col(value) - F.col("__m")).alias("__d"))
    spread = quantiles(apart, "__d", [0.5], small=SMALL).select(F.col("quantiles")[0].alias("__mad"))
    both = F.broadcast(middle.crossJoin(spread))  # one row
    diff = F.col(value) - F.col("__m")
    z = F.when(F.col("__mad") > 1e-9, 0.6745 * diff / F.col("__mad")).when(F.col("__s") > 1e-9, diff / F.col("__s")).otherwise(0.0)
    return df.crossJoin(both).withColumn(into, z).drop("__m", "__s", "__mad")


def group_scale(df: DataFrame, group: str, value: str, least: float = 5.0) -> DataFrame:
    """(group, median, scale): scale is 1.4826 * MAD, but at least `least`."""
    middle = held(quantiles(df, value, [0.5], group, small=SMALL).select(group, F.col("quantiles")[0].alias("median")))
    apart = df.select(group, value).join(middle, group).select(group, F.abs(F.col(value) - F.col("median")).alias("__d"))
    mad = quantiles(apart, "__d", [0.5], group, small=SMALL).select(group, F.col("quantiles")[0].alias("mad"))
    return middle.join(mad, group).select(group, "median", F.greatest(1.4826 * F.col("mad"), F.lit(least)).alias("scale"))


def group_z(df: DataFrame, group: str, value: str, least: float = 5.0, into: str = "z") -> DataFrame:
    return df.join(group_scale(df, group, value, least), group).withColumn(into, (F.col(value) - F.col("median")) / F.col("scale"))


def tercile_bands(df: DataFrame, value: str, into: str = "band", names: tuple[str, str, str] = ("baixa", "media", "alta")) -> DataFrame:
    """Adds the band of value among the exact 33.333 and 66.667 percentiles; the low test is first."""
    cuts = quantiles(df, value, [0.33333, 0.66667], small=SMALL).select(F.col("quantiles").alias("__c"))
    band = F.when(F.col(value) <= F.col("__c")[0], names[0]).when(F.col(value) >= F.col("__c")[1], names[2]).otherwise(names[1])
    return df.crossJoin(F.broadcast(cuts)).withColumn(into, band).drop("__c")


def percentiles(value: Column | str, shares: list[float]) -> Column:
    """Exact percentiles with linear interpolation."""
    return F.percentile(value, shares)


def median_or_zero(value: Column | str) -> Column:
    return F.coalesce(F.median(value), F.lit(0.0))


def fraction(condition: Column) -> Column:
    return F.avg(condition.cast("double"))
