"""Quoted reports that are read in blocks.

A line feed ends a record only outside of quotes. Whether a line begins inside of quotes follows
from the number of quotes before it in its file: each block's parity is counted, the blocks' are
summed up in order (a row a block), and each line's from its block's. Lines that are a record by
themselves are parsed where they are; only the others are put together.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import scan


def lines_in_blocks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(value, file, block, at): the lines of text files, `at` in order within each file's blocks, without gaps.

    They are written once. Spark cuts files by the cores that it has at the time, so what reads the
    files twice can see other blocks, and other tasks' numbers, after cores came or went.
    """
    lines = spark.read.options(**options).text(path)
    return scan.stored(lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")))


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, block, at, first, record): the records of the files, the first of each marked, blank ones left out; file, block, at are their order.

    Lines end with a line feed, before which a carriage return is dropped outside of quotes. A
    quote within a cell must be doubled, and the cell quoted; an unclosed quote takes all lines up
    to the next quote.
    """
    lines = lines_in_blocks(spark, path, lineSep="\n")
    lines = lines.withColumn("value", F.when(F.col("block") == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value")))
    lines = lines.withColumn("odd", F.length(F.regexp_replace("value", f"[^{quote}]+", "")) % 2)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("n"), F.min("at").alias("head"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.join(blocks.select("file", "block", "head", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), ["file", "block"])
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", (F.col("base") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 1)
    placed = placed.withColumn("first", (F.col("block") == 0) & (F.col("at") == F.col("head")))
    alone = ~F.col("inside") & (F.col("odd") == 0)
    whole = placed.where(alone).select("file", "block", "at", "first", F.col("value").alias("record"))
    # a longer record is named by the line it starts with: the last start so far in this block, or in the blocks before
    parts = placed.where(~alone).withColumn("start", F.when(~F.col("inside"), F.struct("block", "at")))
    carried = parts.groupBy("file", "block").agg(F.max("start").alias("last"))
    carried = carried.select("file", "block", F.max("last").over(earlier).alias("carried"))
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = parts.join(carried, ["file", "block"]).withColumn("name", F.coalesce(F.max("start").over(upto), F.col("carried")))
    joined = named.groupBy("file", "name").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
    long = joined.select("file", "name.block", "name.at", "first", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"))
    return whole.unionByName(long).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def read_in_blocks(spark: SparkSession, path: str, delimiter: str = ";", header: bool = True, place: str | None = None) -> DataFrame:
    """All cells as texts, and if it is named, the record's place as a struct. Names come from the files' first records, which must be alike, or are _c0, _c1, ... without a header."""
    rows = records(spark, path)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "maxCharsPerColumn": "-1"}
    top = rows.where("first")
    heads = [r["record"] for r in (top.select("record").distinct().limit(2) if header else top.limit(1)).collect()]
    if len(heads) > 1:
        raise ValueError(f"{path}: files have different headers")
    if not heads:
        return spark.createDataFrame([], "_c0 string")
    cells = next(csv.reader(io.StringIO(heads[0], newline=""), delimiter=delimiter))
    names = [c or f"_c{i}" for i, c in enumerate(cells)] if header else [f"_c{i}" for i in range(len(cells))]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    body = rows.where("not first") if header else rows
    return body.select(F.from_csv("record", schema, options).alias("r"), F.struct("file", "block", "at").alias("p")).select("r.*", *([F.col("p").alias(place)] if place else []))
