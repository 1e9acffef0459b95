"""Sets of ids against each other, in one aggregation however many sets there are."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def memberships(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(key, a boolean for each set): which sets each key is in; up to 63 sets, keys of any type, null is a key like others.

    Every key carries one bit a set, so differences, intersections and unions are conditions on
    the rows of a single shuffle, whose tasks send each key once.
    """
    if len(sets) > 63:
        raise ValueError("more than 63 sets")
    tagged = [df.select(F.col(key).alias(key), F.lit(1 << i).cast("long").alias("__bit")) for i, df in enumerate(sets.values())]
    bits = functools.reduce(DataFrame.union, tagged).groupBy(key).agg(F.bit_or("__bit").alias("__bits"))
    return bits.select(key, *[(F.col("__bits").bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias(name) for i, name in enumerate(sets)])


def bitmaps(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(name, bucket, bitmap): 32,768 whole-number ids a bitmap of 4 KB; nulls are left out."""
    tagged = [df.where(F.col(key).isNotNull()).select(F.lit(name).alias("name"), F.col(key).cast("long").alias("__id")) for name, df in sets.items()]
    rows = functools.reduce(DataFrame.union, tagged).select("name", F.bitmap_bucket_number("__id").alias("bucket"), F.bitmap_bit_position("__id").alias("at"))
    return rows.groupBy("name", "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def overlaps(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(a, b, both, either, only_a, only_b): numbers of distinct ids of each pair of sets, in order of their names' places.

    Ids go to bitmaps before they are shuffled; what is compared is a bitmap a bucket and set.
    """
    names = list(sets)
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i + 1 :]]
    of = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in pairs])
    rows = bitmaps(sets, key).withColumn("p", F.explode(F.filter(of, lambda p: (p["a"] == F.col("name")) | (p["b"] == F.col("name"))))).select("p.*", "name", "bucket", "bitmap")
    size = F.bitmap_count("bitmap")
    shared = F.when(F.count("*") == 2, F.bitmap_count(F.bitmap_and_agg("bitmap"))).otherwise(0)
    by_bucket = rows.groupBy("a", "b", "bucket").agg(
        shared.alias("both"), F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("either"), F.sum(F.when(F.col("name") == F.col("a"), size).otherwise(0)).alias("na"), F.sum(F.when(F.col("name") == F.col("b"), size).otherwise(0)).alias("nb")
    )
    total = by_bucket.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("both", "either", "na", "nb")])
    every = rows.sparkSession.createDataFrame(pairs, "a string, b string")
    out = every.join(total, ["a", "b"], "left").na.fill(0)
    return out.select("a", "b", "both", "either", (F.col("na") - F.col("both")).alias("only_a"), (F.col("nb") - F.col("both")).alias("only_b"))


