"""A runner of batches that can be stopped anywhere and started again.

Its log is a Parquet table to which each batch adds its items' states in one commit. What the log
says is done isn't looked at again, and what has a valid output, though a crash kept it out of
the log, is logged without being handled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import held, numbered

#: handles the items of a batch, writing an output for each
Handle = Callable[[DataFrame], None]
#: (key, ok) of the items of a batch that have an output
Check = Callable[[DataFrame], DataFrame]


class PreflightError(RuntimeError):
    """The first item alone came to nothing, so nothing else was tried."""


def read_log(spark: SparkSession, path: str, key: str, kind: str) -> DataFrame:
    """(key, state, kind, batch, attempt) of all that was logged; empty without a log."""
    schema = f"{key} {kind}, state string, kind string, batch long, attempt int"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def states(log: DataFrame, key: str) -> DataFrame:
    """(key, state, attempts): each item's last state."""
    return log.groupBy(key).agg(F.max_by("state", "attempt").alias("state"), F.max("attempt").alias("attempts"))


def run(items: DataFrame, key: str, handle: Handle, check: Check, log: str, size: int) -> DataFrame:
    """Handles all items (unique by key) and returns their last states; valido or invalido.

    If nothing was logged yet, the first item goes alone (preflight), and its failure ends the run
    with an error. Then come batches of `size` in order of key; after each its outputs are checked
    and its states logged in one commit. Items that failed in a batch are handled once more, each
    alone. The driver holds one failed item at a time.
    """
    spark, kind = items.sparkSession, items.schema[key].dataType.simpleString()

    def attempt(batch: DataFrame, name: str, number: int | None, again: int) -> None:
        valid = check(batch).where("ok").select(key)
        todo = held(batch.join(valid, key, "left_anti"))  # a crash may have come after their outputs and before the log
        if todo.limit(1).count():
            handle(todo)
        ok = check(batch).where("ok").select(key, F.lit("valido").alias("state")).dropDuplicates([key])
        out = batch.select(key).join(ok, key, "left").select(key, F.coalesce("state", F.lit("invalido")).alias("state"), F.lit(name).alias("kind"), F.lit(number).cast("long").alias("batch"), F.lit(again).alias("attempt"))
        out.write.mode("append").parquet(log)

    known = read_log(spark, log, key, kind)
    fresh = not known.limit(1).count()
    left = numbered(items.join(known.select(key).distinct(), key, "left_anti"), key, into="__place")
    many = left.count()
    start = 0
    if fresh and many:
        attempt(left.where("__place = 0").drop("__place"), "preflight", None, 1)
        if states(read_log(spark, log, key, kind), key).first()["state"] != "valido":
            raise PreflightError("the first item has no valid output")
        start = 1
    before = known.agg(F.max("batch")).first()[0]
    number = 0 if before is None else before + 1
    for at in range(start, many, size):
        attempt(left.where(F.col("__place").between(at, min(at + size, many) - 1)).drop("__place"), "lote", number, 1)
        number += 1
    failed = states(read_log(spark, log, key, kind), key).where("state = 'invalido' and attempts = 1")
    for r in held(failed.select(key)).toLocalIterator():
        attempt(items.where(F.col(key) == F.lit(r[0])), "individual", None, 2)
    return states(read_log(spark, log, key, kind), key)
