"""Sources and sinks: tables written to files, read back, and streamed."""

from __future__ import annotations

import atexit
import shutil
import struct
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import signal
from ..sources import archive, archive_source, sinks, tables
from ..streaming import resume


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for files of this application, in spark.checkpoint.dir; a temporary one if that is unset and the master local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that all machines share")
        base = tempfile.mkdtemp(prefix="files-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base}/{spark.sparkContext.applicationId}/{name}"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def report_files(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as a report with quotes, delimiters and line feeds in its cells, read back."""
    path = scratch(spark, "report")
    cell = F.concat(F.lit('"'), F.col("role"), F.lit('"; '), F.substr("text", F.lit(1), F.length("text")), F.lit("\nend"))
    sinks.write_report(_t(spark, d, "conversations").withColumn("cell", cell), path, ["conv_id", "turn", "cell"], force=True)
    return tables.read_report(spark, path, "turn long, conv_id long, cell string").select("conv_id", "turn", "cell")


REPORT_SQL = "SELECT conv_id, turn, '\"' || role || '\"; ' || text || chr(10) || 'end' AS cell FROM conversations"


def line_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents that have a text as a pipe-delimited corpus with comments and blank lines, in files that follow each other, read back with line numbers that go on from file to file."""
    path = scratch(spark, "lines")
    flat = lambda c: F.regexp_replace(c, r"[\r\n|]+", " ")
    rows = F.concat_ws("\n", F.lit("; comment"), F.concat_ws("|", F.format_string("%010d", "doc_id"), flat("lang"), flat("text")), F.lit(""))
    texts = _t(spark, d, "documents").where(F.rlike("text", F.lit(r"[^ \r\n|]")))  # the others aren't numbered
    texts.select("doc_id", rows.alias("value")).orderBy(F.asc_nulls_last("doc_id")).select("value").write.mode("overwrite").text(path)
    return tables.read_lines(spark, path, joined=True, wide=True).select("ident", "text", "line_no")


LINES_SQL = "SELECT doc_id AS ident, trim(regexp_replace(text, '[\\r\\n|]+', ' ', 'g'), ' ') AS text, 3 * row_number() OVER (ORDER BY doc_id) - 1 AS line_no FROM documents WHERE trim(regexp_replace(text, '[\\r\\n|]+', ' ', 'g'), ' ') <> ''"


def json_files(spark: SparkSession, d: str) -> DataFrame:
    """Orders as JSON lines, null fields left out, and read back with a key that the schema doesn't name."""
    path = scratch(spark, "json")
    o = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"), (F.col("o_custkey") * 2).alias("other"))
    sinks.write_jsonl(o, path, ["o_orderkey", "status", "other"], force=True)
    back = tables.read_jsonl(spark, path, "o_orderkey long, status string")
    return back.select("o_orderkey", "status", F.get_json_object("raw", "$.other").cast("long").alias("other"), (~F.contains("raw", F.lit("status"))).alias("left_out"))


JSON_FILES_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status, o_custkey * 2 AS other, o_orderkey % 3 = 0 AS left_out FROM orders"


def id_files(spark: SparkSession, d: str) -> DataFrame:
    """Customer numbers as a list of ids with comments, read back in canonical form."""
    path = scratch(spark, "ids")
    line = F.concat(F.when(F.col("c_custkey") % 4 == 0, "# skipped ").otherwise(" "), F.upper(T.hex_id("c_custkey")), F.lit("  # "), "c_mktsegment")
    _t(spark, d, "customer").select(line.alias("value")).write.mode("overwrite").text(path)
    return tables.read_ids(spark, path).select("id")


IDS_FILES_SQL = "SELECT printf('0x%08x', c_custkey) AS id FROM customer WHERE c_custkey % 4 <> 0"


def assignment_files(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as positional assignments, some blank, behind a row of names, read back."""
    path = scratch(spark, "assignments")
    s = _t(spark, d, "supplier").select(T.hex_id("s_suppkey").alias("a"), F.when(F.col("s_suppkey") % 5 == 0, "").otherwise(F.concat(F.lit("estilo_"), F.col("s_nationkey").cast("string"))).alias("b"))
    spark.createDataFrame([("id_hex", "estilo")], "a string, b string").union(s).write.mode("overwrite").csv(path, sep=";", emptyValue="")
    return tables.read_assignments(spark, path)


ASSIGNMENT_SQL = "SELECT printf('0x%08x', s_suppkey) AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'sem_estilo' ELSE 'estilo_' || s_nationkey END AS style FROM supplier"


def style_files(spark: SparkSession, d: str) -> DataFrame:
    """Nations as reference styles in a TOML file, read back with the default."""
    path = scratch(spark, "styles")
    rows = [{"style": f"n{r['n_nationkey']}", "enabled": r["n_nationkey"] % 4 != 1, "ref_audio": f"C:\\audio \"{r['n_name']}\".wav"} for r in _t(spark, d, "nation").collect()]
    spark.createDataFrame([(sinks.references_toml(rows, "n0"),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    styles, default = tables.read_references(spark, path)
    return styles.select("style", "enabled", "ref_audio", F.lit(default).alias("default_style"))


STYLES_SQL = "SELECT 'n' || n_nationkey AS style, n_nationkey % 4 <> 1 AS enabled, 'C:\\audio \"' || n_name || '\".wav' AS ref_audio, 'n0' AS default_style FROM nation"


def listed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files written for each region, listed with the attributes in their folders' names."""
    path = scratch(spark, "listing")
    _t(spark, d, "nation").select("n_regionkey", F.col("n_name").alias("value")).repartition(1).write.mode("overwrite").partitionBy("n_regionkey").text(path)
    found = tables.list_files(spark, path, r"^part-(\d+)-.*\.txt$", "*.txt", recursive=True)
    return found.select(F.regexp_extract("path", r"n_regionkey=(\d+)/", 1).cast("int").alias("region"), F.col("g1").cast("int").alias("part"), F.col("length").cast("long").alias("length"))


LISTED_SQL = "SELECT n_regionkey AS region, 0::INT AS part, sum(strlen(n_name) + 1)::BIGINT AS length FROM nation GROUP BY n_regionkey"


def fan_out_files(spark: SparkSession, d: str) -> DataFrame:
    """One set of rows as several reports with conditions, counted after reading them back."""
    path = scratch(spark, "fan")
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.fan_out(o, {"all": (None, ["o_orderkey"]), "open": (F.col("o_orderstatus") == "O", ["o_orderkey", "o_orderstatus"]), "dear": (F.col("o_totalprice") > 200_000, ["o_orderkey"])}, path, force=True)
    parts = [tables.read_report(spark, f"{path}/{n}", "o_orderkey long").select(F.lit(n).alias("report"), "o_orderkey") for n in ("all", "open", "dear")]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("report").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


FAN_SQL = """
SELECT 'all' AS report, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders UNION ALL SELECT 'open', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'dear', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_totalprice > 200000"""


def json_summary(spark: SparkSession, d: str) -> DataFrame:
    """A summary of orders as one JSON text, parsed again."""
    made = sinks.summary(_t(spark, d, "orders"), {"orders": F.count("*"), "statuses": F.count_distinct("o_orderstatus"), "highest": F.max("o_orderkey"), "nothing": F.max(F.lit(None).cast("string"))})
    row = spark.createDataFrame([(made,)], "value string").select("value", F.from_json("value", "orders long, statuses long, highest long, nothing string").alias("j"))
    return row.select("j.*", F.contains("value", F.lit('"nothing":null')).alias("null_kept"))


SUMMARY_SQL = "SELECT count(*) AS orders, count(DISTINCT o_orderstatus) AS statuses, max(o_orderkey) AS highest, NULL::VARCHAR AS nothing, true AS null_kept FROM orders"


def _le32(number: Column) -> Column:
    """Four bytes, the lowest first."""
    h = F.lpad(F.hex(number.cast("long")), 8, "0")
    return F.unhex(F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)]))


def _media(data: Column, tag: str = "RIFF") -> Column:
    """A RIFF block of the packed codec, a second for each 1,000 bytes of data (a text)."""
    fmt = struct.pack("<HHIIHH", 0x3041, 1, 48_000, 1000, 1, 16) + bytes(20)
    size = F.octet_length(data)
    head = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"seek" + struct.pack("<I", 4) + bytes(4) + b"data"
    odd = F.when(size % 2 == 1, F.lit(bytes(1))).otherwise(F.lit(b""))
    return F.concat(F.lit(tag.encode()), _le32(len(head) + 4 + size + size % 2), F.lit(head), _le32(size), data.cast("binary"), odd)


def archive_files(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers packed into an archive, in order of their keys, and read back in slices of 4 KB."""
    path = f"{scratch(spark, 'archives')}/all.w3speech"
    side = F.when(F.col("s_suppkey") % 3 == 0, F.substring("s_name", 1, 5)).otherwise("").cast("binary")
    items = _t(spark, d, "supplier").select(
        F.col("s_suppkey").cast("long").alias("ident"), F.col("s_nationkey").cast("long").alias("ident_high"), _media(F.col("s_name")).alias("media"), side.alias("companion"), (F.octet_length("s_name") / 1000).alias("duration"), F.lit(7).alias("trailer_kind")
    )
    archive_source.write_archive(items, path, "ident", force=True)
    got = archive_source.read_archives(spark, path, slice_bytes=4096)
    return got.select("entry_index", "ident", "ident_high", "codec", "channels", "rate", F.round("duration", 6).alias("duration"), "has_seek", "trailer_kind", "companion_bytes", "companion_sha256", "error")


ARCHIVE_SQL = """
SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS entry_index, s_suppkey::BIGINT AS ident, s_nationkey::BIGINT AS ident_high, 'wem-opus' AS codec, 1::BIGINT AS channels, 48000::BIGINT AS rate,
  round(strlen(s_name) / 1000.0::DOUBLE, 6) AS duration, true AS has_seek, 7::BIGINT AS trailer_kind, CASE WHEN s_suppkey % 3 = 0 THEN 5 ELSE 0 END::BIGINT AS companion_bytes,
  sha256(CASE WHEN s_suppkey % 3 = 0 THEN left(s_name, 5) ELSE '' END) AS companion_sha256, NULL::VARCHAR AS error FROM supplier"""


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    """An archive of all customers in which some entries are damaged, by their key, read in slices of 64 KB."""
    path = f"{scratch(spark, 'damaged')}/customers.w3speech"
    key = F.col("c_custkey")
    items = _t(spark, d, "customer").select(
        key.cast("long").alias("ident"), F.lit(0).alias("ident_high"), F.when(key % 10 == 1, _media(F.col("c_name"), "RIFX")).otherwise(_media(F.col("c_name"))).alias("media"), F.lit(b"").alias("companion"),
        (F.octet_length("c_name") / 1000 + F.when(key % 10 == 2, 1).otherwise(0)).alias("duration"), F.lit(1).alias("trailer_kind"),
    ).withColumns({"media_bytes": F.length("media").cast("long"), "companion_bytes": F.lit(0).cast("long")})
    placed = archive.layout(items, "ident").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "ident")  # not to be put together again
    archive_source.write_placed(placed, path, "overwrite")
    return archive_source.read_archives(spark, path, slice_bytes=65_536)


def damaged_archive(spark: SparkSession, d: str) -> DataFrame:
    """How many entries of a damaged archive can't be used, by reason, and how many can."""
    got = _damaged(spark, d)
    bad = archive_source.skipped(got).select(F.col("error").alias("reason"), "n")
    return bad.union(got.where("error is null").agg(F.lit("usable").alias("reason"), F.count("*").alias("n")))


DAMAGED_SQL = """
SELECT CASE WHEN c_custkey % 10 = 1 THEN 'no RIFF/WAVE' WHEN c_custkey % 10 = 2 THEN 'trailer duration differs' ELSE 'usable' END AS reason, count(*) AS n
FROM customer GROUP BY 1"""


def archive_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Entries of a damaged archive for wanted ids, which the reader takes in: their media's hash or what is wrong with them."""
    path = f"{scratch(spark, 'damaged')}/customers.w3speech"
    _damaged(spark, d)
    wanted = {1, 2, 3, 7, 13, 42, 777, 10**9}
    return archive_source.read_archives(spark, path, wanted=wanted, slice_bytes=65_536).select("ident", "duration", "media_bytes", "error")


LOOKUP_SQL = """
SELECT c_custkey::BIGINT AS ident, CASE WHEN c_custkey % 10 NOT IN (1, 2) THEN strlen(c_name) / 1000.0::DOUBLE END AS duration,
  CASE WHEN c_custkey % 10 NOT IN (1, 2) THEN 76 + strlen(c_name) + strlen(c_name) % 2 END::BIGINT AS media_bytes,
  CASE c_custkey % 10 WHEN 1 THEN 'no RIFF/WAVE' WHEN 2 THEN 'trailer duration differs' END AS error
FROM customer WHERE c_custkey IN (1, 2, 3, 7, 13, 42, 777)"""


def _tone(level: int, loud: int, quiet: int) -> bytes:
    """A wave file: quiet, a square wave of this level, quiet, at 8,000 Hz."""
    pulse = struct.pack("<h", level) * 4 + struct.pack("<h", -level) * 4
    data = bytes(2 * quiet) + pulse * (loud // 8) + bytes(2 * quiet)
    return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 16_000, 2, 16) + b"data" + struct.pack("<I", len(data)) + data


def wave_files(spark: SparkSession, d: str) -> DataFrame:
    """A wave file for each nation, of a length and level that follow from its number, measured."""
    path = scratch(spark, "waves")
    for r in _t(spark, d, "nation").collect():
        n = r["n_nationkey"]
        sinks.write_bytes(spark, f"{path}/n{n}.wav", _tone(1000 * (n + 1), 800 * (n + 2), 1600), force=True)
    got = signal.measure_files(spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path))
    return got.select(
        F.regexp_extract("path", r"n(\d+)\.wav$", 1).cast("int").alias("nation"), F.round("duration_s", 6).alias("seconds"), F.round("trim_start_s", 6).alias("start"), F.round("trim_end_s", 6).alias("end"), F.round("peak", 5).alias("peak"),
        F.round("tail_margin_ms", 3).alias("margin"), F.round("active_s", 6).alias("active"), (F.col("micro_pauses") + F.col("long_pauses") + F.col("blips")).alias("breaks"), F.col("error").isNull().alias("readable"),
    )


WAVES_SQL = "SELECT n_nationkey AS nation, round((800 * (n_nationkey + 2) + 3200) / 8000.0::DOUBLE, 6) AS seconds, 0.2::DOUBLE AS start, round(0.2 + (n_nationkey + 2) / 10.0::DOUBLE, 6) AS end, round(1000 * (n_nationkey + 1) / 32768.0::DOUBLE, 5) AS peak, 200.0::DOUBLE AS margin, round((n_nationkey + 2) / 10.0::DOUBLE, 6) AS active, 0::BIGINT AS breaks, true AS readable FROM nation"


def streamed_files(spark: SparkSession, d: str) -> DataFrame:
    """Events that arrive as JSON files, handed on once each, a file a batch; and a restart that finds nothing new."""
    base = scratch(spark, "stream")
    source, target = f"{base}/in", f"{base}/out"
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, True)
    _t(spark, d, "events").select("event_id", "event_type", "user_id").repartition(3).write.mode("overwrite").json(source)
    handle = lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(target)
    for _ in range(2):
        resume.stream_lines(spark, source, "event_id long, event_type string, user_id long", f"{base}/state", handle, files_per_batch=1).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"))


STREAM_SQL = "SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type"


def windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and five minutes."""
    out = resume.windowed_counts(_t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), "ts", "event_type")
    return out.select(F.unix_timestamp("window.start").alias("start"), "event_type", "n")


WINDOW_SQL = "SELECT (epoch(time_bucket(INTERVAL '5 minutes', ts)))::BIGINT AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"


QUERIES = {
    "report_files": report_files, "line_files": line_files, "json_files": json_files, "id_files": id_files, "assignment_files": assignment_files, "style_files": style_files, "listed_files": listed_files,
    "fan_out_files": fan_out_files, "json_summary": json_summary, "streamed_files": streamed_files, "windowed_counts": windowed_counts, "archive_files": archive_files,
    "wave_files": wave_files, "damaged_archive": damaged_archive, "archive_lookup": archive_lookup,
}
ORACLE_SQL = {
    "report_files": REPORT_SQL, "line_files": LINES_SQL, "json_files": JSON_FILES_SQL, "id_files": IDS_FILES_SQL, "assignment_files": ASSIGNMENT_SQL, "style_files": STYLES_SQL, "listed_files": LISTED_SQL,
    "fan_out_files": FAN_SQL, "json_summary": SUMMARY_SQL, "streamed_files": STREAM_SQL, "windowed_counts": WINDOW_SQL, "archive_files": ARCHIVE_SQL,
    "wave_files": WAVES_SQL, "damaged_archive": DAMAGED_SQL, "archive_lookup": LOOKUP_SQL,
}
