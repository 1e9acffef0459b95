"""Queries of operators for orders, series and groups of any size, of interval tables and of the batch runner."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals, quantiles, scan, series
from ..sources import sinks
from ..streaming import runner
from .source_queries import scratch


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text_order_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Where each document begins if texts are laid end to end in their order as texts, and its batch of 100."""
    docs = _t(spark, d, "documents").select("doc_id", "text", F.octet_length("text").alias("bytes"))
    placed = scan.placed_in_order(docs, "bytes", "text", "doc_id", total_into="offset", place_into="place")
    return placed.select("doc_id", F.col("offset").cast("long").alias("offset"), F.floor(F.col("place") / 100).alias("batch"))


TEXT_ORDER_SQL = """
SELECT doc_id, coalesce(sum(strlen(text)) OVER (ORDER BY text NULLS FIRST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset,
  (row_number() OVER (ORDER BY text NULLS FIRST, doc_id) - 1) // 100 AS batch FROM documents"""


def hot_key_places(spark: SparkSession, d: str) -> DataFrame:
    """Each line item's place and the quantity before it, in order of a status that has two values, and then of its key."""
    rows = _t(spark, d, "lineitem").select("l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"))
    out = scan.placed_in_order(rows, "quantity", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", total_into="before", place_into="place", pieces=64)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "place", F.col("before").cast("long").alias("before"))


HOT_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER w - 1 AS place, (sum(l_quantity::BIGINT) OVER w - l_quantity::BIGINT)::BIGINT AS before FROM lineitem
WINDOW w AS (ORDER BY l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING)"""


def group_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles of prices by return flag, each selected over all tasks."""
    got = quantiles.quantiles(_t(spark, d, "lineitem"), "l_extendedprice", [0.01, 0.5, 0.9, 0.999], "l_returnflag", small=500)
    return got.select("l_returnflag", "n", *[F.round(F.col("quantiles")[i], 6).alias(name) for i, name in enumerate(("p1", "median", "p90", "p999"))])


GROUP_SQL = """
SELECT l_returnflag, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.01), 6) AS p1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
  round(quantile_cont(l_extendedprice, 0.9), 6) AS p90, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY l_returnflag"""


def _one_series(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").select(F.lit("all").alias("series"), F.col("event_id").alias("i"), "event_type", "value")


def long_runs(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of errors and others in all events as one series."""
    return series.runs(_one_series(spark, d), "series", "i", F.col("event_type") == "error").select("flag", "start", "end", "length")


RUNS_SQL = """
WITH e AS (SELECT event_id AS i, event_type = 'error' AS flag FROM events),
g AS (SELECT i, flag, i - row_number() OVER (PARTITION BY flag ORDER BY i) AS k FROM e)
SELECT flag, min(i) AS start, max(i) AS end, count(*) AS length FROM g GROUP BY flag, k"""


def long_bridges(spark: SparkSession, d: str) -> DataFrame:
    """All events as one series whose gaps of up to two others between views and clicks are closed: the stretches left, and the short ones among long gaps."""
    rows = _one_series(spark, d)
    closed = series.bridged(rows, "series", "i", F.col("event_type").isin("view", "click"), 2)
    out = series.runs(closed, "series", "i", F.col("flag"))
    return out.where("flag").select("start", "end", "length")


BRIDGES_SQL = """
WITH e AS (SELECT event_id AS i, event_type IN ('view', 'click') AS flag FROM events),
g AS (SELECT i, flag, i - row_number() OVER (PARTITION BY flag ORDER BY i) AS k FROM e),
r AS (SELECT flag, min(i) AS a, max(i) AS b, count(*) AS n FROM g GROUP BY flag, k),
c AS (SELECT *, flag OR n <= 2 AND lag(a) OVER (ORDER BY a) IS NOT NULL AND lead(a) OVER (ORDER BY a) IS NOT NULL AS closed FROM r),
m AS (SELECT *, CASE WHEN lag(closed) OVER (ORDER BY a) IS DISTINCT FROM closed THEN 1 ELSE 0 END AS fresh FROM c),
s AS (SELECT *, sum(fresh) OVER (ORDER BY a) AS k FROM m)
SELECT min(a) AS start, max(b) AS end, sum(n)::BIGINT AS length FROM s WHERE closed GROUP BY k"""


def long_steps(spark: SparkSession, d: str) -> DataFrame:
    """Each event's change of value from the one before, and the edges where two of three are high, in one series."""
    return series.first_differences(_one_series(spark, d), "series", "i", "value").select("i", F.round("step", 6).alias("step"))


STEPS_SQL = "SELECT event_id AS i, round(value - lag(value) OVER (ORDER BY event_id), 6) AS step FROM events"


def long_edges(spark: SparkSession, d: str) -> DataFrame:
    return series.k_of_n_edges(_one_series(spark, d), "series", "i", F.col("value") > 90, 3, 4).select("first_index", "last_index")


EDGES_SQL = """
WITH e AS (SELECT event_id AS i, (value > 90)::INT AS a FROM events),
f AS (SELECT i, sum(a) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS ahead, sum(a) OVER (ORDER BY i ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS behind FROM e)
SELECT min(CASE WHEN ahead >= 3 THEN i END) AS first_index, max(CASE WHEN behind >= 3 THEN i END) AS last_index FROM f"""


# A wave of a supplier: 0.2 s of silence, a tone, a gap, the tone again, 0.2 s of silence, at 8,000 Hz
_LOUD = {1: ("C0", "40"), 2: ("0040", "00C0"), 3: ("000040", "0000C0")}
_TONE, _GAP = "(200 + 20 * (s_suppkey % 5))", "(40 + 20 * (s_suppkey % 9))"  # ms


def _wave(width: int) -> Column:
    up, down = _LOUD[width]
    quiet = "80" if width == 1 else "00" * width
    still = lambda ms: F.repeat(F.lit(quiet), (ms * 8).cast("int"))
    loud = lambda ms: F.repeat(F.lit(up * 4 + down * 4), ms.cast("int"))
    tone, gap = F.expr(_TONE), F.expr(_GAP)
    payload = F.concat(still(F.lit(200)), loud(tone), still(gap), loud(tone), still(F.lit(200)))
    size = (400 + 2 * tone + gap) * 8 * width
    little = lambda n: F.concat(*[F.substring(F.lpad(F.hex(n.cast("long")), 8, "0"), i, 2) for i in (7, 5, 3, 1)])
    head = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000 * width, width, 8 * width) + b"data"
    return F.unhex(F.concat(F.lit(b"RIFF".hex()), little(size + 36), F.lit(head.hex()), little(size), payload))


def _waves(spark: SparkSession, d: str) -> DataFrame:
    """The suppliers' waves, of 8, 16 and 24 bits in turn, written as files and listed with their contents."""
    path = scratch(spark, "supplier_waves")
    width = F.col("s_suppkey") % 3
    made = _t(spark, d, "supplier").select(F.format_string("s%d.wav", "s_suppkey").alias("name"), F.when(width == 0, _wave(1)).when(width == 1, _wave(2)).otherwise(_wave(3)).alias("content"))
    sinks.write_files(made, path, "name", "content")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "s*.wav").load(path)
    return files.select(F.regexp_extract("path", r"s(\d+)\.wav$", 1).cast("long").alias("s_suppkey"), "content")


def wave_pauses(spark: SparkSession, d: str) -> DataFrame:
    return intervals.pauses(_waves(spark, d), "s_suppkey").select("s_suppkey", F.round("start_ms", 3).alias("start_ms"), F.round("length_ms", 3).alias("length_ms"), "error")


WAVE_PAUSES_SQL = f"SELECT s_suppkey, round((200 + {_TONE})::DOUBLE, 3) AS start_ms, round({_GAP}::DOUBLE, 3) AS length_ms, NULL::VARCHAR AS error FROM supplier"


def wave_edges(spark: SparkSession, d: str) -> DataFrame:
    return intervals.voice_edges(_waves(spark, d), "s_suppkey").select("s_suppkey", F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"))


WAVE_EDGES_SQL = f"SELECT s_suppkey, 0.1::DOUBLE AS start_s, round((300 + 2 * {_TONE} + {_GAP}) / 1000.0::DOUBLE, 6) AS end_s FROM supplier"


def wave_quiet(spark: SparkSession, d: str) -> DataFrame:
    return intervals.quiet_intervals(_waves(spark, d), "s_suppkey").select("s_suppkey", "start", "end", "rate")


WAVE_QUIET_SQL = f'SELECT s_suppkey, 8 * (200 + {_TONE})::BIGINT AS start, 8 * (200 + {_TONE} + {_GAP})::BIGINT AS "end", 8000::BIGINT AS rate FROM supplier WHERE {_GAP} >= 100'


def wave_silence(spark: SparkSession, d: str) -> DataFrame:
    """Waves with 60 ms put into their quiet places: the pauses they have then, with derived rates."""
    files = scan.held(_waves(spark, d))
    longer = scan.held(intervals.with_silence(files, intervals.quiet_intervals(files, "s_suppkey"), 60.0, "s_suppkey"))
    measured = intervals.rates(longer, "s_suppkey").select("s_suppkey", F.round("duration_s", 6).alias("duration_s"), F.round("mean_pause_ms", 3).alias("mean_pause_ms"), F.round("voice_s", 6).alias("voice_s"), F.round("pauses_per_s", 6).alias("pauses_per_s"))
    return measured.join(longer.select("s_suppkey", F.octet_length("content").alias("bytes")), "s_suppkey")


WAVE_SILENCE_SQL = f"""
WITH w AS (SELECT s_suppkey, {_TONE} AS tone, {_GAP} + CASE WHEN {_GAP} >= 100 THEN 60 ELSE 0 END AS gap, CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS width FROM supplier)
SELECT s_suppkey, round((400 + 2 * tone + gap) / 1000.0::DOUBLE, 6) AS duration_s, round(gap::DOUBLE, 3) AS mean_pause_ms, round(2 * tone / 1000.0::DOUBLE, 6) AS voice_s,
  round(1000.0::DOUBLE / (2 * tone + gap), 6) AS pauses_per_s, (44 + (400 + 2 * tone + gap) * 8 * width)::INT AS bytes FROM w"""


def batch_run(spark: SparkSession, d: str) -> DataFrame:
    """Customers handled in batches of a third: some come to nothing in a batch and are handled again alone; a second start finds nothing to do."""
    base = scratch(spark, "batch_run")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, True)
    items = _t(spark, d, "customer").select("c_custkey")
    many = items.count()
    slow, lost = many // 3, many // 2  # one that needs to be alone, and one that never succeeds

    def handle(batch: DataFrame) -> None:
        alone = F.lit(batch.count() == 1)
        out = batch.where((F.col("c_custkey") != lost) & (alone | (F.col("c_custkey") != slow)))
        out.withColumn("done", F.lit(True)).write.mode("append").parquet(f"{base}/out")

    def check(batch: DataFrame) -> DataFrame:
        made = spark.read.schema("c_custkey long, done boolean").option("ignoreMissingFiles", "true").parquet(f"{base}/out") if _exists(spark, f"{base}/out") else spark.createDataFrame([], "c_custkey long, done boolean")
        return batch.select("c_custkey").join(made.select("c_custkey", F.col("done").alias("ok")), "c_custkey")

    for _ in range(2):
        runner.run(items, "c_custkey", handle, check, f"{base}/log", max(1, many // 3))
    log = runner.read_log(spark, f"{base}/log", "c_custkey", "bigint")
    made = spark.read.parquet(f"{base}/out").groupBy("c_custkey").agg(F.count("*").alias("outputs"))
    return runner.states(log, "c_custkey").join(made, "c_custkey", "left").select("c_custkey", "state", "attempts", F.coalesce("outputs", F.lit(0)).alias("outputs"))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


BATCH_SQL = """
WITH n AS (SELECT count(*) AS many FROM customer)
SELECT c_custkey, CASE WHEN c_custkey = many // 2 THEN 'invalido' ELSE 'valido' END AS state, CASE WHEN c_custkey IN (many // 2, many // 3) THEN 2 ELSE 1 END AS attempts,
  CASE WHEN c_custkey = many // 2 THEN 0 ELSE 1 END::BIGINT AS outputs FROM customer, n"""


QUERIES = {
    "text_order_offsets": text_order_offsets, "hot_key_places": hot_key_places, "group_quantiles": group_quantiles, "long_runs": long_runs, "long_bridges": long_bridges, "long_steps": long_steps,
    "long_edges": long_edges, "wave_pauses": wave_pauses, "wave_edges": wave_edges, "wave_quiet": wave_quiet, "wave_silence": wave_silence, "batch_run": batch_run,
}
ORACLE_SQL = {
    "text_order_offsets": TEXT_ORDER_SQL, "hot_key_places": HOT_SQL, "group_quantiles": GROUP_SQL, "long_runs": RUNS_SQL, "long_bridges": BRIDGES_SQL, "long_steps": STEPS_SQL,
    "long_edges": EDGES_SQL, "wave_pauses": WAVE_PAUSES_SQL, "wave_edges": WAVE_EDGES_SQL, "wave_quiet": WAVE_QUIET_SQL, "wave_silence": WAVE_SILENCE_SQL, "batch_run": BATCH_SQL,
}
