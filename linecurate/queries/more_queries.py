"""Scalar functions, routing, resumption and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import relational, scoring, stats
from ..sources import sinks
from ..streaming import resume


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def bands_and_levels(spark, d):
    v = F.col("value")
    duration, pace, pause = T.duration_band(v / 20), T.pace_band(v / 10), T.pause_band(F.col("event_id") % 4, v * 10)
    return _t(spark, d, "events").select(
        "event_id", T.profile_key(duration, pace, F.lit("media"), pause).alias("profile"), T.clip(v, 10.0, 90.0).alias("clipped"), F.round(T.dbfs(v / 1000), 6).alias("level"),
        F.round(T.semitones(v + 100, F.lit(180.0)), 6).alias("semitones"), F.round(T.cents_apart(v + 100, F.lit(180.0)), 5).alias("cents"),
        T.as_number(F.concat(F.lit(" "), F.replace(v.cast("string"), F.lit("."), F.lit(",")))).alias("parsed"),
    )


BANDS_SQL = """
SELECT event_id, CASE WHEN value / 20 < 1.2 THEN 'curta' WHEN value / 20 < 4 THEN 'media' ELSE 'longa' END || '__ritmo_' || CASE WHEN value / 10 < 4.5 THEN 'lento' WHEN value / 10 <= 7 THEN 'normal' ELSE 'rapido' END
  || '__int_media__' || CASE WHEN event_id % 4 = 0 THEN 'sem_pausa' WHEN event_id % 4 <= 2 AND value * 10 <= 500 THEN 'pausa_leve' ELSE 'pausa_frequente' END AS profile, least(greatest(value, 10), 90) AS clipped,
  round(20 * log10(greatest(value / 1000, 1e-12::DOUBLE)), 6) AS level, round(12 * log2((value + 100) / 180), 6) AS semitones, round(abs(1200 * log2((value + 100) / 180)), 5) AS cents, value AS parsed FROM events"""


def safe_names(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.safe_name("text").alias("name"), T.first_text(F.lit(""), F.lit(None).cast("string"), "lang").alias("chosen"), T.fold_spacing("text").alias("folded"))


SAFE_SQL = f"""
SELECT doc_id, coalesce(nullif(left(trim(regexp_replace(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9._''-]+', '_', 'g'), '_.'), 70), ''), 'termo') AS name, lang AS chosen,
  trim(regexp_replace(lower(strip_accents(text)), '\\s+', ' ', 'g')) AS folded FROM documents"""


def human_sizes(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", T.human_size(F.col("o_orderkey") * 4099).alias("size"))


SIZES_SQL = """SELECT o_orderkey, CASE WHEN b >= 1073741824 THEN printf('%.2f GiB', b / 1073741824.0::DOUBLE) WHEN b >= 1048576 THEN printf('%.2f MiB', b / 1048576.0::DOUBLE) WHEN b >= 1024 THEN printf('%.2f KiB', b / 1024.0::DOUBLE)
  ELSE printf('%d B', b) END AS size FROM (SELECT o_orderkey, o_orderkey * 4099 AS b FROM orders)"""


def annotation_defaults(spark, d):
    notes = _t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("role").alias("tag"))
    return relational.annotated(_t(spark, d, "documents").select("doc_id"), notes, "doc_id", "tag", "aprovado")


NOTES_SQL = """
WITH n AS (SELECT conv_id, min(role) AS tag, min(role) <> max(role) AS conflict FROM conversations GROUP BY 1)
SELECT doc_id, coalesce(tag, 'aprovado') AS tag, coalesce(conflict, false) AS conflict FROM documents LEFT JOIN n ON conv_id = doc_id"""


def routing(spark, d):
    docs = _t(spark, d, "documents")
    return sinks.routes(docs, F.col("lang"), {"en": "a/english", "de": "b/german", "fr": "c/french"}, T.hex_id("doc_id")).select("doc_id", "target")


ROUTING_SQL = "SELECT doc_id, CASE lang WHEN 'en' THEN 'a/english/' WHEN 'de' THEN 'b/german/' WHEN 'fr' THEN 'c/french/' END || printf('0x%08x', doc_id) AS target FROM documents"


def playlists(spark, d):
    return sinks.playlists(_t(spark, d, "conversations").select("conv_id", "turn", F.concat_ws("_", "turn", "role").alias("name")), "conv_id", "turn", "name")


PLAYLISTS_SQL = "SELECT conv_id, '#EXTM3U' || chr(10) || string_agg(turn || '_' || role, chr(10) ORDER BY turn, role) AS playlist FROM conversations GROUP BY conv_id"


def resume_status(spark, d):
    return resume.status(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id", F.col("quality") == 1)


STATUS_SQL = """
WITH o AS (SELECT doc_id, max((quality = 1)::INT) AS ok FROM labels GROUP BY 1)
SELECT d.doc_id, CASE WHEN ok = 1 THEN 'valido' WHEN ok = 0 THEN 'invalido' ELSE 'pendente' END AS state FROM documents d LEFT JOIN o USING (doc_id)"""


def retry_batches(spark, d):
    return resume.retry_plan(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id", F.col("quality") == 1, 100)


RETRY_SQL = """
WITH o AS (SELECT doc_id, max((quality = 1)::INT) AS ok FROM labels GROUP BY 1), s AS (SELECT d.doc_id, ok FROM documents d LEFT JOIN o USING (doc_id)),
f AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM s WHERE ok IS NULL)
SELECT doc_id, CASE WHEN i = 0 THEN -1 ELSE i // 100 END AS batch, CASE WHEN i = 0 THEN 'preflight' ELSE 'lote' END AS kind FROM f UNION ALL SELECT doc_id, NULL, 'individual' FROM s WHERE ok = 0"""


def places_compared(spark, d):
    o = _t(spark, d, "orders")
    return relational.paired_in_order(o.select(F.col("o_orderkey").alias("k"), "o_orderkey"), o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), "o_orderkey"), "k", "o_orderkey")


PLACES_SQL = """
WITH a AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders), b AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders WHERE o_orderstatus <> 'P')
SELECT coalesce(a.k, b.k) AS k, a.p AS left_place, b.p AS right_place, a.p IS DISTINCT FROM b.p AS moved FROM a FULL JOIN b ON a.k = b.k"""


def expressiveness(spark, d):
    z = _t(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("a"), F.col("p_size").cast("double").alias("b"))
    for c in ("a", "b"):
        z = stats.robust_z(z, c, into=f"z_{c}")
    a, b = F.col("z_a"), F.col("z_b")
    return z.select("p_partkey", F.round(scoring.expressiveness(a, b, a, b, a, F.col("b") / 50), 4).alias("score"))


EXPRESS_SQL = """
WITH m AS (SELECT median(p_retailprice) AS ma, mad(p_retailprice) AS da, median(p_size::DOUBLE) AS mb, mad(p_size::DOUBLE) AS db FROM part),
z AS (SELECT p_partkey, p_size, least(greatest(0.6745 * (p_retailprice - ma) / da, -3), 3) AS a, least(greatest(0.6745 * (p_size - mb) / db, -3), 3) AS b FROM part, m)
SELECT p_partkey, round(a * 0.35::DOUBLE + b * 0.2::DOUBLE + a * 0.1::DOUBLE + b * 0.25::DOUBLE + a * 0.1::DOUBLE - greatest(0, p_size / 50.0::DOUBLE - 0.35), 4) AS score FROM z"""

NAMES = (
    "bands_and_levels BANDS", "safe_names SAFE", "human_sizes SIZES", "annotation_defaults NOTES", "routing ROUTING", "playlists PLAYLISTS", "resume_status STATUS", "retry_batches RETRY",
    "places_compared PLACES", "expressiveness EXPRESS",
)
QUERIES = {n.split()[0]: globals()[n.split()[0]] for n in NAMES}
ORACLE_SQL = {n.split()[0]: globals()[n.split()[1] + "_SQL"] for n in NAMES}
