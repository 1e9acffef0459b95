"""Resuming work: what is valid is kept, the rest is pending, in batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sequences import batches


def pending(items: DataFrame, outputs: DataFrame, key: str, valid: Column, force: bool = False) -> DataFrame:
    """Items without a valid output; all of them if force."""
    return items if force else items.join(outputs.where(valid).select(key), key, "left_anti")


def status(items: DataFrame, outputs: DataFrame, key: str, valid: Column) -> DataFrame:
    """(key, state): valido, invalido or pendente, without running anything."""
    done = outputs.select(key, F.coalesce(valid, F.lit(False)).alias("__ok")).groupBy(key).agg(F.max("__ok").alias("__ok"))
    return items.join(done, key, "left").select(key, F.when(F.col("__ok"), "valido").when(~F.col("__ok"), "invalido").otherwise("pendente").alias("state"))


def retry_plan(items: DataFrame, outputs: DataFrame, key: str, valid: Column, size: int) -> DataFrame:
    """(key, batch, kind): a first item alone (preflight), then batches; items that failed before go singly, last."""
    state = status(items, outputs, key, valid).where("state <> 'valido'")
    fresh = batches(state.where("state = 'pendente'").select(key), key, size)
    first = F.col(key) == F.min(key).over(Window.partitionBy("batch").orderBy(key))
    fresh = fresh.select(key, F.when((F.col("batch") == 0) & first, -1).otherwise(F.col("batch")).alias("batch"), F.when((F.col("batch") == 0) & first, "preflight").otherwise("lote").alias("kind"))
    failed = state.where("state = 'invalido'").select(key, F.lit(None).cast("long").alias("batch"), F.lit("individual").alias("kind"))
    return fresh.unionByName(failed)


def stream_lines(spark: SparkSession, folder: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], files_per_batch: int = 100) -> StreamingQuery:
    """JSON files that arrive in a folder, handed on once each, in batches; ends when none is left.

    The checkpoint knows what was done, so a restart goes on where it stopped.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, kind: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by kind and tumbling window of a stream (or table), late rows dropped after `late`."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count("*").alias("n"))
