"""Session settings that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches to about BATCH_BYTES (a longer single row makes a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the session's checkpoint folder, so that lost executors lose none of it.

    The folder is spark.checkpoint.dir, or what SparkContext.setCheckpointDir was given; it must be
    shared by all machines, so without one a cluster raises an error. Only a session whose master
    is local gets a temporary folder, removed when the session's process ends.
    """
    context = df.sparkSession.sparkContext
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None) and context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df written once as a Parquet table in the checkpoint folder and read again, and the table's path.

    Unlike a checkpoint this runs df's last stage only once. remove() deletes the table.
    """
    spark = df.sparkSession
    cut(spark.range(0))  # there is a folder, or an error
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(*frames: DataFrame) -> None:
    """Removes the files of frames that cut gave and that nothing lazy reads any more, and lets go of the shuffles behind them."""
    for df in frames:
        context = df.sparkSession.sparkContext
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            path = context._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        context._jvm.System.gc()  # the context's cleaner removes files of shuffles that are out of reach


def steady_memory() -> None:
    """Lets this process keep up to 128 MB of freed memory, where the C library can be told so.

    Else each large array's pages go back to the system and have to be mapped anew for the next one.
    """
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        mallopt(-3, 64 << 20)  # M_MMAP_THRESHOLD
        mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
