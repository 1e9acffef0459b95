"""Places and prefix sums of all rows in one order, by pieces that grow in number with the session's partitions.

Rows are dealt out to ranges of the order and written once to the checkpoint folder, sorted, with their range and their
place in it. What then goes through one task is a row a range. A key that many rows share is cut too: its rows are told
apart by a hash of all their columns, and equal rows by their place before the shuffle.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a partition


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (spark.checkpoint.dir); a local master gets a temporary one, a cluster without one an error."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that all machines share")
        made = tempfile.mkdtemp(prefix="checkpoints-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        context.setCheckpointDir(made)
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def held(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder."""
    folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df written once as a Parquet table in the checkpoint folder and read again: its last stage runs once, and what needs some columns doesn't read the others."""
    spark = df.sparkSession
    path = f"{folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranges(df: DataFrame, *order: str | Column, pieces: int | None = None) -> DataFrame:
    """df, written, with __piece (a range of the order, numbered in order) and __at (the row's place in it, from 0).

    Rows that are equal in `order` come in an order that the rest of their columns decides, wholly
    equal ones in any. Nulls are first, unless a column of `order` says otherwise.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told_apart = [f"`{name}`" for name, kind in df.dtypes if "map<" not in kind and kind not in ("variant", "void")]
    # sorted before they are numbered, so that a task that is run again numbers them alike
    marked = df.withColumn("__mark", F.xxhash64(*told_apart)).sortWithinPartitions("__mark").withColumn("__row", F.monotonically_increasing_id())
    keys = [*order, "__mark", "__row"]
    dealt = marked.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys)
    return held(dealt.withColumn("__piece", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))).drop("__mark", "__row"))


def _before(totals: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Each piece's sums over the pieces before it; one row a piece (and group)."""
    earlier = Window.partitionBy(*group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, "__piece", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums])


def numbered(df: DataFrame, *order: str | Column, into: str = "place", pieces: int | None = None) -> DataFrame:
    """Adds each row's place in the order, from 0, without a window over rows."""
    dealt = ranges(df, *order, pieces=pieces)
    counts = dealt.groupBy("__piece").agg(F.count("*").alias("__base"))
    first = F.broadcast(_before(counts, [], ["__base"]))  # one row a piece
    return dealt.join(first, "__piece").withColumn(into, F.col("__base") + F.col("__at")).drop("__piece", "__at", "__base")


def placed_in_order(df: DataFrame, value: str, *order: str | Column, total_into: str, place_into: str | None = None, pieces: int | None = None) -> DataFrame:
    """Adds the sum of value over all rows that come earlier in the order, and how many come earlier if place_into is given."""
    dealt = ranges(df, *order, pieces=pieces)
    sums = dealt.groupBy("__piece").agg(F.coalesce(F.sum(value), F.lit(0)).alias("__base"), F.count("*").alias("__first"))
    first = F.broadcast(_before(sums, [], ["__base", "__first"]))  # one row a piece
    inside = Window.partitionBy("__piece").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(first, "__piece").withColumn(total_into, F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (out.withColumn(place_into, F.col("__first") + F.col("__at")) if place_into else out).drop("__piece", "__at", "__base", "__first")


def running_total(df: DataFrame, value: str, *order: str | Column, into: str = "before", pieces: int | None = None) -> DataFrame:
    """Adds the sum of value over all rows that come earlier in the order, as `into`."""
    return placed_in_order(df, value, *order, total_into=into, pieces=pieces)
