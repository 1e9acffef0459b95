"""Relational, statistical and sequence operators, rules and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import integrity, relational, scoring, sequences, signal, stats


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- dedup, conflicts, integrity


def dedup_with_provenance(spark, d):
    li = _t(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"), F.col("l_returnflag").alias("flag"), "l_partkey")
    out = integrity.dedup_with_provenance(li, "k", "flag", "l_partkey")
    return out.select("k", "flag", F.array_join(F.transform("lines", lambda x: x.cast("string")), "|").alias("parts"), "rows", "conflict")


DEDUP_SQL = """
SELECT l_orderkey || '-' || l_linenumber AS k, min(l_returnflag) AS flag, string_agg(l_partkey::VARCHAR, '|' ORDER BY l_partkey) AS parts, count(*) AS rows, min(l_returnflag) <> max(l_returnflag) AS conflict
FROM lineitem GROUP BY 1"""


def conflict_detection(spark, d):
    li = _t(spark, d, "lineitem")
    return integrity.equivalent_groups(li, ["l_orderkey", "l_linenumber"], "l_partkey", "l_quantity", ["l_returnflag", "l_linestatus"], 5.0)


CONFLICT_SQL = """
SELECT l_orderkey, l_linenumber, count(*) AS rows,
  (max(l_quantity) - arg_min(l_quantity, l_partkey) <= 5 AND arg_min(l_quantity, l_partkey) - min(l_quantity) <= 5 AND count(DISTINCT l_returnflag || l_linestatus) = 1) AS equivalent
FROM lineitem GROUP BY ALL"""


def field_difference_set(spark, d):
    li = _t(spark, d, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return integrity.field_differences(li, "k", ["l_partkey", "l_suppkey", "l_extendedprice"], {"l_returnflag": None, "l_linestatus": None, "l_tax": 0.02, "l_discount": 0.03})


FIELDS_SQL = """
WITH w AS (SELECT l_orderkey || '-' || l_linenumber AS k, *, first(l_returnflag) OVER o AS f1, first(l_linestatus) OVER o AS f2, first(l_tax) OVER o AS f3, first(l_discount) OVER o AS f4
  FROM lineitem WINDOW o AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice))
SELECT k, count(*) AS rows, concat_ws('|', max(CASE WHEN abs(l_discount - f4) > 0.03 THEN 'l_discount' END), max(CASE WHEN l_linestatus <> f2 THEN 'l_linestatus' END),
  max(CASE WHEN l_returnflag <> f1 THEN 'l_returnflag' END), max(CASE WHEN abs(l_tax - f3) > 0.02 THEN 'l_tax' END)) AS differences FROM w GROUP BY k"""


def multi_match_resolution(spark, d):
    li = _t(spark, d, "lineitem")
    out = integrity.occurrence_status(li, "l_orderkey", "l_suppkey", ["l_linenumber", "l_partkey"], ["l_returnflag"])
    return out.select("l_orderkey", "status", "rows", "variants", F.col("chosen.l_partkey").alias("chosen_part"))


MULTI_SQL = """
SELECT l_orderkey, CASE WHEN count(*) = 1 THEN 'ok' WHEN count(DISTINCT l_returnflag) > 1 THEN 'duplicado_divergente' WHEN count(DISTINCT l_suppkey) > 1 THEN 'id_high_expandido'
  ELSE 'duplicado_equivalente' END AS status, count(*) AS rows, count(DISTINCT l_suppkey) AS variants, arg_max(l_partkey, l_linenumber * 10000000 + l_partkey) AS chosen_part FROM lineitem GROUP BY l_orderkey"""


def duplicate_keys(spark, d):
    return integrity.duplicates(_t(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


DUP_SQL = "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def last_wins(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return integrity.last_wins(e, "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


LAST_SQL = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id"


def tolerance_conflicts(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "value")
    return integrity.previous_conflicts(e, "user_id", "event_id", "value", 50.0)


TOLERANCE_SQL = """SELECT * FROM (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) WHERE abs(value - previous) > 50"""


def hash_compare(spark, d):
    docs = _t(spark, d, "documents")
    h = docs.select("doc_id", F.sha2("text", 256).alias("sha256"))
    return h.groupBy("sha256").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))


HASH_SQL = "SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1"


# --- joins and merges


def update_join(spark, d):
    docs, labels = _t(spark, d, "documents").select("doc_id", "lang", F.col("n_chars").alias("quality")), _t(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return relational.update_join(docs, labels, "doc_id", ["quality"])


UPDATE_SQL = "SELECT d.doc_id, d.lang, coalesce(l.quality, d.n_chars)::BIGINT AS quality, l.doc_id IS NOT NULL AS updated FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def left_lookup_default(spark, d):
    return relational.lookup(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), "doc_id", {"quality": -1, "toxic": 0})


LOOKUP_SQL = "SELECT d.doc_id, d.source, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def semi_join_selection(spark, d):
    return relational.selected(_t(spark, d, "documents").select("doc_id", "n_chars"), _t(spark, d, "labels").where("quality = 1"), "doc_id")


SEMI_SQL = "SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)"


def anti_join_missing(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    urgent = _t(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    return relational.missing(c, urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


ANTI_SQL = "SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')"


def set_equality_diff(spark, d):
    o, li = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k")), _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return relational.key_differences(o, li, "k")


SET_SQL = """
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS side
FROM (SELECT DISTINCT o_orderkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL"""


def merge_with_policy(spark, d):
    base = _t(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "gerar").otherwise("usar_original").alias("action"), F.col("toxic").cast("string").alias("text"), F.lit("base").alias("reason"))
    docs = _t(spark, d, "documents")
    over = docs.select(F.col("doc_id").alias("id"), F.lit("gerar").alias("action"), (F.col("n_chars") % 2).cast("string").alias("text"), F.when(F.col("doc_id") % 2 == 0, "base").otherwise("novo").alias("reason"))
    return relational.merge_corrections(base, over)


MERGE_SQL = """
WITH b AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'gerar' ELSE 'usar_original' END AS action, toxic::VARCHAR AS text, 'base' AS reason FROM labels),
o AS (SELECT doc_id AS id, 'gerar' AS action, (n_chars % 2)::VARCHAR AS text, CASE WHEN doc_id % 2 = 0 THEN 'base' ELSE 'novo' END AS reason FROM documents),
m AS (SELECT coalesce(b.id, o.id) AS id, b.action AS ba, b.text AS bt, b.reason AS br, o.action AS oa, o.text AS ot, o.reason AS orr, CASE WHEN o.id IS NULL THEN 'base' WHEN b.id IS NULL THEN 'adicionado'
  WHEN b.action = 'usar_original' AND o.action = 'gerar' THEN 'conflito_mantido_base' WHEN b.action = o.action AND b.text = o.text THEN 'inalterado' ELSE 'atualizado' END AS status FROM b FULL JOIN o ON b.id = o.id)
SELECT id, CASE WHEN status IN ('base', 'conflito_mantido_base') THEN ba ELSE oa END AS action, CASE WHEN status IN ('base', 'conflito_mantido_base') THEN bt ELSE ot END AS text,
  CASE WHEN status IN ('base', 'conflito_mantido_base') THEN br WHEN status = 'adicionado' THEN orr WHEN contains(br, orr) THEN br ELSE br || ' | ' || orr END AS reason, status FROM m"""


def overlay_precedence(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "source", "n_chars")
    layers = [docs, docs.where("n_chars >= 500").withColumn("source", F.lit("second")), docs.where("n_chars >= 1500").withColumn("source", F.lit("third"))]
    return relational.overlay(layers, "doc_id").select("doc_id", "source", "n_chars", F.col("layer").cast("int").alias("layer"))


OVERLAY_SQL = """SELECT doc_id, CASE WHEN n_chars >= 1500 THEN 'third' WHEN n_chars >= 500 THEN 'second' ELSE source END AS source, n_chars, CASE WHEN n_chars >= 1500 THEN 2 WHEN n_chars >= 500 THEN 1 ELSE 0 END AS layer FROM documents"""


def fallback_union(spark, d):
    labels = _t(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.lit("label").alias("origin"))
    return relational.with_fallback(labels, _t(spark, d, "documents").select("doc_id"), "doc_id", {"quality": -1, "origin": "fallback"})


FALLBACK_SQL = """SELECT doc_id, quality, 'label' AS origin FROM labels UNION ALL SELECT doc_id, -1, 'fallback' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def term_min_example(spark, d):
    terms = _t(spark, d, "benchmark").select(F.regexp_extract("text", "[A-Za-z]{6,}", 0).alias("term")).where("term <> ''").distinct()
    n = terms.count()
    docs = _t(spark, d, "documents").select("doc_id", "text", F.length("text").alias("size"))
    # a term is one word: lines are cut into words once, instead of matching each term against each line
    words = docs.select("doc_id", "size", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0))).alias("term"))
    hits = words.join(F.broadcast(terms) if n <= 100_000 else terms, "term")
    return hits.groupBy("term").agg(F.count("*").alias("lines"), F.min(F.struct("size", "doc_id")).alias("m")).select("term", "lines", F.col("m.doc_id").alias("example_id"))


TERM_SQL = """
WITH t AS (SELECT DISTINCT regexp_extract(text, '[A-Za-z]{6,}') AS term FROM benchmark WHERE regexp_extract(text, '[A-Za-z]{6,}') <> ''),
w AS (SELECT DISTINCT doc_id, length(text) AS size, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS term FROM documents)
SELECT term, count(*) AS lines, arg_min(doc_id, size * 1000000 + doc_id) AS example_id FROM w JOIN t USING (term) GROUP BY term"""


def coverage_report(spark, d):
    docs, labels, conv = _t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), _t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")).distinct()
    sets = {
        "rotulado": labels.select("doc_id"), "sem_rotulo": relational.missing(docs, labels, "doc_id"), "toxico": labels.where("toxic = 1").select("doc_id"), "conversa": conv,
        "conversa_sem_documento": relational.missing(conv, docs, "doc_id"),
    }
    tagged = None
    for name, rows in sets.items():
        rows = rows.withColumn("categoria", F.lit(name))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return integrity.coverage_ids(tagged, "doc_id", "categoria", [*sets, "nada"], " ")


COVERAGE_SQL = """
WITH s AS (SELECT 'rotulado' AS c, doc_id AS k FROM labels UNION SELECT 'sem_rotulo', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION SELECT 'toxico', doc_id FROM labels WHERE toxic = 1 UNION SELECT 'conversa', conv_id FROM conversations
  UNION SELECT 'conversa_sem_documento', conv_id FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM documents)),
n AS (SELECT * FROM (VALUES ('rotulado'), ('sem_rotulo'), ('toxico'), ('conversa'), ('conversa_sem_documento'), ('nada')) v(categoria))
SELECT categoria, count(k) AS quantidade, coalesce(string_agg(k::VARCHAR, ' ' ORDER BY k::VARCHAR), '') AS ids FROM n LEFT JOIN s ON s.c = n.categoria GROUP BY categoria"""


def fixed_domain_counts(spark, d):
    return integrity.fixed_domain_counts(_t(spark, d, "events"), "event_type", ["view", "click", "error", "nothing"])


DOMAIN_SQL = "SELECT v.t AS event_type, count(e.event_id) AS n FROM (VALUES ('view'), ('click'), ('error'), ('nothing')) v(t) LEFT JOIN events e ON e.event_type = v.t GROUP BY 1"


# --- ranking, samples


def top_n_per_group(spark, d):
    e = _t(spark, d, "events").select("event_type", "event_id", "value")
    return relational.top_n(e, ["event_type"], [F.desc("value"), "event_id"], 12)


TOP_SQL = "SELECT event_type, event_id, value, rn AS position FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 12"


def running_index_in_group(spark, d):
    c = _t(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn")
    return sequences.running_index(c, ["conv_id"], ["turn"])


INDEX_SQL = "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations WHERE role = 'user'"


def systematic_sample(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "n_chars")
    return relational.systematic_sample(docs, "doc_id", "n_chars", 25, mandatory=[42, 7]).select("doc_id", "n_chars")


SAMPLE_SQL = """
WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS rank FROM documents WHERE doc_id NOT IN (42, 7)),
n AS (SELECT count(*) AS n FROM r), p AS (SELECT round_even(i * (n - 1)::DOUBLE / 22::DOUBLE, 0)::BIGINT AS rank FROM range(23) t(i), n)
SELECT doc_id, n_chars FROM r WHERE rank IN (SELECT rank FROM p) UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id IN (42, 7)"""


def top_k_preselect(spark, d):
    """Two-stage top k: a cheap score picks 120, a dearer one 12 of them."""
    docs = _t(spark, d, "documents")
    cheap = docs.select("doc_id", "text", T.preselection_score("text", F.col("n_chars") / 100.0).alias("cheap")).orderBy(F.desc("cheap"), F.desc("doc_id")).limit(120)
    return cheap.select("doc_id", F.round("cheap", 6).alias("cheap"), T.words("text").alias("words")).orderBy(F.desc("words"), F.desc("doc_id")).limit(12)


PRESELECT_SQL = """
WITH c AS (SELECT doc_id, text, least(len(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ]+(?:[''’-][A-Za-zÀ-ÖØ-öø-ÿ]+)?')), 35) / 10.0::DOUBLE
  + 1.5 * (length(text) - length(replace(text, '?', '')) + length(text) - length(replace(text, '!', ''))) + 0.7 * ((length(text) - length(replace(text, '...', ''))) // 3 + length(text) - length(replace(text, '…', '')))
  + 0.25 * (3 * length(text) - length(replace(text, ',', '')) - length(replace(text, ';', '')) - length(replace(text, ':', ''))) + 0.2 * least(length(text) - length(replace(text, '.', '')), 4)
  - 0.08 * abs(n_chars / 100.0::DOUBLE - 6.5) AS cheap FROM documents),
p AS (SELECT *, len(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ]+(?:[''’-][A-Za-zÀ-ÖØ-öø-ÿ]+)?'))::BIGINT AS words FROM c ORDER BY cheap DESC, doc_id DESC LIMIT 120)
SELECT doc_id, round(cheap, 6) AS cheap, words FROM p ORDER BY words DESC, doc_id DESC LIMIT 12"""


# --- statistics


def ecdf_percentile(spark, d):
    return stats.ecdf(_t(spark, d, "events").select("event_id", "value"), "value").select("event_id", F.round("percentile", 6).alias("percentile"))


ECDF_SQL = "SELECT event_id, round(cume_dist() OVER (ORDER BY value) * 100, 6) AS percentile FROM events"


def ecdf_vs_baseline(spark, d):
    e = _t(spark, d, "events").select("event_id", "event_type", "value")
    return stats.ecdf_against(e, "value", e.where("event_type = 'view'"), "value").select("event_id", F.round("percentile", 6).alias("percentile"))


BASELINE_SQL = """
WITH m AS (SELECT event_id, value, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS b FROM events),
c AS (SELECT *, sum(b) OVER (ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n, sum(b) OVER () AS total FROM m)
SELECT event_id, round(100.0::DOUBLE * n / total, 6) AS percentile FROM c"""


def priority_bands(spark, d):
    e = stats.ecdf(_t(spark, d, "events").select("event_id", "event_type", "value"), "value")
    p = scoring.percentile_priority(F.col("percentile"), (F.col("event_type") == "error") & (F.col("value") > 100))
    return e.select("event_id", p.alias("priority"), relational.by_priority(p, ["alta", "media", "baixa", "ok"]).alias("sort_key"))


BANDS_SQL = """
WITH c AS (SELECT *, cume_dist() OVER (ORDER BY value) * 100 AS p FROM events),
b AS (SELECT event_id, CASE WHEN event_type = 'error' AND value > 100 THEN 'alta' WHEN p >= 99 THEN 'alta' WHEN p >= 97.5 THEN 'media' WHEN p >= 95 THEN 'baixa' ELSE 'ok' END AS priority FROM c)
SELECT event_id, priority, CASE priority WHEN 'alta' THEN 1 WHEN 'media' THEN 2 WHEN 'baixa' THEN 3 ELSE 4 END AS sort_key FROM b"""


def robust_z_global(spark, d):
    return stats.robust_z(_t(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice").select("o_orderkey", F.round("z", 6).alias("z"))


ROBUST_SQL = """WITH m AS (SELECT median(o_totalprice) AS m, mad(o_totalprice) AS mad FROM orders) SELECT o_orderkey, round(0.6745 * (o_totalprice - m) / mad, 6) AS z FROM orders, m"""


def robust_z_group(spark, d):
    return stats.group_z(_t(spark, d, "events").select("event_id", "event_type", "value"), "event_type", "value").select("event_id", F.round("z", 6).alias("z"), F.round("scale", 6).alias("scale"))


GROUP_Z_SQL = """WITH m AS (SELECT event_type, median(value) AS m, greatest(1.4826 * mad(value), 5) AS s FROM events GROUP BY 1) SELECT event_id, round((value - m) / s, 6) AS z, round(s, 6) AS scale FROM events JOIN m USING (event_type)"""


def tercile_bands(spark, d):
    return stats.tercile_bands(_t(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice").select("p_partkey", "band")


TERCILE_SQL = """WITH c AS (SELECT quantile_cont(p_retailprice::DOUBLE, 0.33333::DOUBLE) AS a, quantile_cont(p_retailprice::DOUBLE, 0.66667::DOUBLE) AS b FROM part)
SELECT p_partkey, CASE WHEN p_retailprice <= a THEN 'baixa' WHEN p_retailprice >= b THEN 'alta' ELSE 'media' END AS band FROM part, c"""


def percentile_summary(spark, d):
    out = _t(spark, d, "events").groupBy("event_type").agg(
        stats.percentiles("value", [0.1, 0.25, 0.75, 0.9]).alias("p"), stats.median_or_zero("value").alias("median"), F.stddev_pop("value").alias("deviation"), stats.fraction(F.col("value") < 20).alias("low_share")
    )
    r = lambda c: F.round(c, 6)
    return out.select("event_type", *[r(F.col("p")[i]).alias(n) for i, n in enumerate(("p10", "p25", "p75", "p90"))], r("median").alias("median"), r("deviation").alias("deviation"), r("low_share").alias("low_share"))


PERCENTILE_SQL = """
SELECT event_type, round(quantile_cont(value, 0.1::DOUBLE), 6) AS p10, round(quantile_cont(value, 0.25::DOUBLE), 6) AS p25, round(quantile_cont(value, 0.75::DOUBLE), 6) AS p75, round(quantile_cont(value, 0.9::DOUBLE), 6) AS p90,
  round(median(value), 6) AS median, round(stddev_pop(value), 6) AS deviation, round(avg((value < 20)::INT::DOUBLE), 6) AS low_share FROM events GROUP BY 1"""


def paired_version_delta(spark, d):
    e = _t(spark, d, "events")
    side = lambda kind, p: e.where(F.col("event_type") == kind).groupBy("user_id").agg(F.avg("value").alias(f"{p}_pitch"), F.max("value").alias(f"{p}_energy"), F.count("*").cast("double").alias(f"{p}_duration"), (F.min("value") / 100).alias(f"{p}_pause"))
    pairs = side("view", "old").join(side("click", "new"), "user_id").withColumn("group", F.col("user_id") % 5)
    out = scoring.version_summary(pairs, "group")
    return out.select("group", *[F.round(c, 6).alias(c) for c in ("pitch_delta", "energy_delta", "duration_ratio", "pause_delta")], "remarks")


PAIRED_SQL = """
WITH s AS (SELECT user_id, event_type, avg(value) AS p, max(value) AS e, count(*)::DOUBLE AS d, min(value) / 100 AS s FROM events GROUP BY ALL),
m AS (SELECT o.user_id % 5 AS "group", median(o.p - n.p) AS pitch_delta, median(o.e - n.e) AS energy_delta, median(o.d / n.d) AS duration_ratio, median(o.s - n.s) AS pause_delta
  FROM s o JOIN s n ON o.user_id = n.user_id AND o.event_type = 'view' AND n.event_type = 'click' GROUP BY 1)
SELECT "group", round(pitch_delta, 6) AS pitch_delta, round(energy_delta, 6) AS energy_delta, round(duration_ratio, 6) AS duration_ratio, round(pause_delta, 6) AS pause_delta,
  concat_ws(' | ', CASE WHEN pitch_delta >= 0.75 THEN 'altura mais variada' WHEN pitch_delta <= -0.75 THEN 'altura menos variada' ELSE 'altura semelhante' END,
  CASE WHEN energy_delta >= 1.5 THEN 'energia maior' WHEN energy_delta <= -1.5 THEN 'energia menor' END, CASE WHEN duration_ratio < 0.9 THEN 'mais curta' WHEN duration_ratio > 1.1 THEN 'mais longa' END,
  CASE WHEN pause_delta >= 0.04 THEN 'mais pausas' WHEN pause_delta <= -0.04 THEN 'menos pausas' END) AS remarks FROM m"""


# --- rules


def best_attempt(spark, d):
    e = _t(spark, d, "events").where("value > 0").select("user_id", "event_id", "value", (F.col("event_id") % 12).alias("frames"))
    score = scoring.attempt_score(F.col("value") + 100, F.lit(195.0), F.lit(0.1), F.col("frames"), F.lit(0.6), F.col("value"), F.lit(50.0))
    scored = e.withColumn("score", F.round(score, 6))
    return scored.groupBy("user_id").agg(F.min_by(F.struct("event_id", "score"), F.struct("score", "event_id")).alias("b")).select("user_id", "b.event_id", "b.score")


ATTEMPT_SQL = """
WITH s AS (SELECT user_id, event_id, round(abs(1200 * log2((value + 100) / 195)) / 50 + CASE WHEN value + 100 < 150 THEN 160 + (50 - value) * 3 WHEN value + 100 < 165 THEN 80 + (65 - value) * 2 ELSE 0 END
  + 0.1::DOUBLE * 28 + CASE WHEN event_id % 12 < 4 THEN 35 ELSE 0 END + abs(ln(value / 50)) * 2, 6) AS score FROM events WHERE value > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score, event_id) AS rn FROM s) SELECT user_id, event_id, score FROM r WHERE rn = 1"""


def risk_score(spark, d):
    u = _t(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("raw_micro"), F.count_if(F.col("event_type") == "click").alias("final_micro"), (F.count("*") / 10).cast("int").alias("punctuation"),
        F.count_if(F.col("value") > 300).alias("raw_blips"), F.count_if(F.col("value") > 400).alias("final_blips"), F.max("value").alias("tail_island_ms"), F.avg("value").alias("tail_margin_ms"),
        (F.avg("value") / 40).alias("processing_speed"), (F.median("value") / 40).alias("effective_speed"),
    )
    m = u.withColumns({"syllable_pct": F.col("user_id") % 101 + 0.0, "syllable_rate": F.lit(7.2), "letter_pct": F.col("user_id") % 103 + 0.0, "letter_rate": F.lit(19.0), "raw_pause_pct": F.col("user_id") % 107 + 0.0, "final_pause_pct": F.col("user_id") % 109 + 0.0})
    m = m.withColumns({"clipping": F.when(F.col("user_id") % 11 == 0, 0.001).otherwise(0.0), "max_step": F.col("user_id") % 40 + 0.0, "duration_change": F.col("user_id") % 90 - 45.0})
    return scoring.quality_risk(m).select("user_id", "risk", "reasons")


RISK_SQL = """
WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS rm, count(*) FILTER (WHERE event_type = 'click') AS fm, count(*) // 10 AS pu, count(*) FILTER (WHERE value > 300) AS b1, count(*) FILTER (WHERE value > 400) AS b2,
  max(value) AS ti, avg(value) AS tm, greatest(avg(value) / 40, median(value) / 40) AS sp FROM events GROUP BY 1),
x AS (SELECT *, greatest(0, rm - pu - 1) AS ex, b1 > 0 OR b2 > 0 AS bl, user_id % 101 >= 97.5 OR user_id % 103 >= 99.5 AS de, user_id % 107 >= 99 AND rm >= pu + 2 AS rp, user_id % 109 >= 98 AND fm >= pu + 2 AS fp, user_id % 11 = 0 AS cl, abs(user_id % 90 - 45) >= 40 AS du FROM u)
SELECT user_id, ((CASE WHEN ex >= 3 THEN 38 WHEN ex = 2 THEN 24 WHEN ex = 1 THEN 10 ELSE 0 END) + (CASE WHEN bl THEN 40 ELSE 0 END) + (CASE WHEN ti > 0 AND ti <= 100 THEN 42 WHEN ti > 100 THEN 16 ELSE 0 END)
  + (CASE WHEN tm < 25 THEN 30 WHEN tm < 45 THEN 12 ELSE 0 END) + (CASE WHEN sp >= 1.18 THEN 26 WHEN sp >= 1.12 THEN 14 ELSE 0 END)
  + (CASE WHEN user_id % 101 >= 99.5 THEN 30 WHEN user_id % 101 >= 97.5 THEN 16 WHEN user_id % 103 >= 99.5 THEN 20 ELSE 0 END) + (CASE WHEN rp THEN 20 WHEN fp THEN 12 ELSE 0 END)
  + (CASE WHEN cl THEN 45 WHEN user_id % 40 >= 28 THEN 18 ELSE 0 END) + (CASE WHEN du THEN 12 ELSE 0 END))::DOUBLE AS risk,
  concat_ws(' | ', CASE WHEN ex >= 2 THEN 'micropausas' END, CASE WHEN bl THEN 'interrupção' END, CASE WHEN ti > 0 THEN 'ilha final' END, CASE WHEN tm < 45 THEN 'margem final' END, CASE WHEN sp >= 1.12 THEN 'velocidade' END,
  CASE WHEN de THEN 'densidade' END, CASE WHEN rp OR fp THEN 'pausas' END, CASE WHEN cl THEN 'clipping' END, CASE WHEN NOT cl AND user_id % 40 >= 28 THEN 'salto' END, CASE WHEN du THEN 'duração' END) AS reasons FROM x"""


SPOKEN = ("Vamos embora", "Ha, ha, ha", "Oi", "", "São três")


def identity_scores(spark, d):
    z = stats.group_z(_t(spark, d, "events").select("event_id", "event_type", "value"), "event_type", "value")
    f0, u = F.col("value") + 130, lambda limit: F.when(F.col("value") + 130 < limit, 0.9).otherwise(0.1)
    known, failed = F.col("event_id") % 997 == 0, F.col("event_id") % 89 == 5
    spoken = F.element_at(F.array(*map(F.lit, SPOKEN)), F.pmod(F.col("event_id"), F.lit(len(SPOKEN))).cast("int") + 1)
    return z.select(
        "event_id", F.round(scoring.identity_risk(f0, u(160), u(170), F.col("z"), known, failed), 6).alias("risk"), scoring.identity_priority(f0, u(160), u(170), u(180), F.col("z"), known, failed).alias("priority"),
        scoring.version_priority(F.col("event_id") % 6, F.col("value") / 50, f0, 200 - f0).alias("version"), scoring.pitch_decision(F.col("event_id") % 6, F.col("value") / 50, F.col("event_id") % 20, f0, u(160)).alias("decision"),
    ).withColumn("folder", scoring.review_folder(F.col("decision"), spoken))


IDENTITY_SQL = f"""
WITH m AS (SELECT event_type, median(value) AS m, greatest(1.4826 * mad(value), 5) AS s FROM events GROUP BY 1),
x AS (SELECT event_id, value, value + 130 AS f, (value - m) / s AS z, CASE WHEN value + 130 < 160 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS a, CASE WHEN value + 130 < 170 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS b,
  CASE WHEN value + 130 < 180 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS c, event_id % 6 AS w, value / 50 AS du, event_id % 20 AS fr FROM events JOIN m USING (event_type)),
y AS (SELECT event_id, CASE WHEN event_id % 997 = 0 OR event_id % 89 = 5 THEN 100 ELSE round(least(greatest(least(greatest((185 - f) / 45, 0), 1) * 45 + a * 30 + b * 15 + least(greatest((-z - 1.5) / 3, 0), 1) * 10, 0), 100), 6) END AS risk,
  CASE WHEN event_id % 997 = 0 OR event_id % 89 = 5 THEN 'alta' WHEN f <= 155 AND a >= 0.7 THEN 'alta' WHEN f <= 168 AND b >= 0.7 THEN 'media' WHEN f <= 180 AND c >= 0.7 THEN 'baixa' WHEN z <= -3.5 AND b >= 0.45 THEN 'baixa' ELSE 'ok' END AS priority,
  CASE WHEN w >= 2 AND du >= 0.8 AND f <= 160 AND 200 - f >= 35 THEN 'alta' WHEN w >= 2 AND du >= 0.8 AND f <= 175 AND 200 - f >= 30 THEN 'media' WHEN NOT (w >= 2 AND du >= 0.8) AND f <= 165 AND 200 - f >= 35 THEN 'curta' ELSE 'ok' END AS version,
  CASE WHEN w <= 1 OR du < 0.8 THEN 'vocalizacao_curta_inconclusiva' WHEN fr >= 8 AND f <= 155 AND a >= 0.65 THEN 'forte_suspeita_masculina'
  WHEN fr >= 8 AND f <= 172 AND a >= 0.55 THEN 'suspeita_moderada' WHEN fr < 8 THEN 'pitch_insuficiente' ELSE 'provavel_falso_positivo' END AS decision FROM x)
SELECT *, CASE WHEN decision = 'forte_suspeita_masculina' THEN '01_forte_suspeita_masculina' WHEN decision = 'suspeita_moderada' THEN '02_falas_revisao_manual'
  WHEN decision = 'pitch_insuficiente' AND event_id % 5 IN (0, 4) THEN '02_falas_revisao_manual' WHEN decision IN ('pitch_insuficiente', 'vocalizacao_curta_inconclusiva') THEN '03_vocalizacoes_curtas'
  ELSE '04_falsos_positivos_pyin' END AS folder FROM y"""


def duration_plan(spark, d):
    li = _t(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"), (F.col("l_quantity") / 10 + 0.2).alias("original"), (F.col("l_quantity") / 10 * (1 + F.col("l_discount") * 6) + 0.1 - F.col("l_tax") * 8).alias("trimmed")
    ).where("trimmed > 0")
    p = scoring.duration_plan(F.col("original"), F.col("trimmed"))
    out = li.withColumn("p", p).groupBy("k").agg(F.min("p.status").alias("status"), F.round(F.max("p.speed"), 6).alias("speed"), F.round(F.sum("p.delta_pct"), 4).alias("delta"), F.max(scoring.final_status(F.col("original"), F.col("trimmed"))).alias("final"))
    return out


PLAN_SQL = """
WITH l AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k, l_quantity / 10 + 0.2 AS o, l_quantity / 10 * (1 + l_discount * 6) + 0.1 - l_tax * 8 AS t FROM lineitem),
s AS (SELECT *, least(greatest(1, t / greatest(o, o * 1.15 - least(0.02, o * 0.02))), 1.2) AS speed FROM l WHERE t > 0),
f AS (SELECT *, t / speed AS fin, greatest(o * 1.15, o + 0.5) AS allowed FROM s)
SELECT k, min(CASE WHEN fin < o * 0.6 THEN 'revisar_curta' WHEN fin > allowed + 0.001 THEN 'revisar_longa' ELSE 'ok' END) AS status, round(max(speed), 6)::DOUBLE AS speed, round(sum((fin / o - 1) * 100), 4) AS delta,
  max(CASE WHEN t < o * 0.6 THEN 'aviso_curta' WHEN t > allowed + 0.02 THEN 'aviso_longa' ELSE 'ok' END) AS final FROM f GROUP BY k"""


def term_priorities(spark, d):
    terms = _t(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{5,}"), 0)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    risky = F.col("term").startswith("Th")
    return terms.select("term", "n", scoring.term_priority(risky & (F.col("n") > 50), F.col("n")).alias("priority"), scoring.scope_advice(risky, F.length("term") > 10).alias("scope"))


TERMS_SQL = """
WITH t AS (SELECT unnest(regexp_extract_all(text, '[A-Z][a-z]{5,}')) AS term FROM documents), c AS (SELECT term, count(*) AS n FROM t GROUP BY 1)
SELECT term, n, CASE WHEN starts_with(term, 'Th') AND n > 50 THEN 'alta' WHEN n >= 20 THEN 'alta' WHEN n >= 5 THEN 'media' WHEN n >= 2 THEN 'baixa' ELSE 'rara' END AS priority,
  CASE WHEN starts_with(term, 'Th') THEN 'ambiguo' WHEN length(term) > 10 THEN 'frase' ELSE 'termo' END AS scope FROM c"""


# --- sequences


def running_offset(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.col("n_chars").alias("size"))
    return sequences.running_offset(docs, "size", "doc_id", base=100).select("doc_id", "offset")


OFFSET_SQL = "SELECT doc_id, (100 + coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS \"offset\" FROM documents"


def batch_plan(spark, d):
    return sequences.batches(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 250)


BATCH_SQL = "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 250 AS batch FROM orders"


def _series(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", "value", "ts")
    return sequences.running_index(e, ["user_id"], ["ts", "event_id"], "i").withColumn("i", F.col("i") - 1)


SERIES = "s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value > 30 AS on_ FROM events)"
ISLANDS = SERIES + ", r AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, on_ ORDER BY i) AS g FROM s), g AS (SELECT user_id, on_, min(i) AS a, max(i) AS b, count(*) AS n FROM r GROUP BY user_id, on_, g)"


def k_of_n_edges(spark, d):
    return sequences.k_of_n_edges(_series(spark, d), "user_id", "i", F.col("value") > 30)


EDGES_SQL = f"""WITH {SERIES}, f AS (SELECT *, sum(on_::INT) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS a, sum(on_::INT) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS b FROM s)
SELECT user_id, min(i) FILTER (WHERE a >= 2) AS first_index, max(i) FILTER (WHERE b >= 2) AS last_index FROM f GROUP BY user_id"""


def runs_islands(spark, d):
    return sequences.runs(_series(spark, d), "user_id", "i", F.col("value") > 30).select("user_id", F.col("flag").alias("active"), "start", F.col("end").alias("last"), "length")


RUNS_SQL = f"WITH {ISLANDS} SELECT user_id, on_ AS active, a AS start, b AS last, n AS length FROM g"


def bridge_gaps(spark, d):
    b = sequences.bridged(_series(spark, d), "user_id", "i", F.col("value") > 30)
    return b.groupBy("user_id").agg(F.count_if("flag").alias("active"), F.count("*").alias("frames"))


BRIDGE_SQL = f"""WITH {ISLANDS}, h AS (SELECT *, lag(a) OVER w IS NOT NULL AND lead(a) OVER w IS NOT NULL AS inner_ FROM g WINDOW w AS (PARTITION BY user_id ORDER BY a))
SELECT user_id, coalesce(sum(n) FILTER (WHERE on_ OR (n <= 2 AND inner_)), 0)::BIGINT AS active, sum(n)::BIGINT AS frames FROM h GROUP BY user_id"""


def blips(spark, d):
    return sequences.short_islands(_series(spark, d), "user_id", "i", F.col("value") > 30, 2, 2)


BLIPS_SQL = f"""WITH {ISLANDS}, h AS (SELECT *, lag(n) OVER w AS gb, lead(n) OVER w AS ga FROM g WINDOW w AS (PARTITION BY user_id ORDER BY a))
SELECT user_id, a AS start, n AS length, gb AS gap_before, ga AS gap_after FROM h WHERE on_ AND n <= 2 AND gb >= 2 AND ga >= 2"""


def run_counts(spark, d):
    return sequences.count_runs(_series(spark, d), "user_id", "i", F.col("value") > 30, 3)


COUNT_SQL = f"WITH {ISLANDS} SELECT user_id, count(*) AS runs FROM g WHERE on_ AND n >= 3 GROUP BY user_id"


def first_difference(spark, d):
    s = sequences.first_differences(_series(spark, d), "user_id", ["i"], "value")
    return s.groupBy("user_id").agg(F.round(F.median(F.abs("step")), 6).alias("median_step"), F.round(F.max(F.abs("step")), 6).alias("max_step"))


DIFF_SQL = f"""WITH {SERIES}, t AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY i) AS step FROM s)
SELECT user_id, round(median(abs(step)), 6) AS median_step, round(max(abs(step)), 6) AS max_step FROM t GROUP BY user_id"""


# --- signals


def array_signal_metrics(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    square = F.aggregate(F.transform("x", lambda v: v * v), F.lit(0.0), lambda a, v: a + v)
    rms = F.sqrt(square / F.size("x"))
    return e.select("vec_id", F.round(F.array_max(F.transform("x", lambda v: F.abs(v))), 6).alias("peak"), F.round(rms, 6).alias("rms"), F.round(T.dbfs(rms), 4).alias("level"), F.size(F.filter("x", lambda v: F.abs(v) >= 0.25)).cast("long").alias("clipped"))


ARRAY_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), r AS (SELECT *, sqrt(list_sum([v * v FOR v IN x]) / len(x)) AS rms FROM e)
SELECT vec_id, round(list_max([abs(v) FOR v IN x]), 6) AS peak, round(rms, 6) AS rms, round(20 * log10(greatest(rms, 1e-12::DOUBLE)), 4) AS level, len([v FOR v IN x IF abs(v) >= 0.25])::BIGINT AS clipped FROM r"""


def frame_energy(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    frames = F.transform(F.sequence(F.lit(0), F.floor((F.size("x") - 1) / 8).cast("int")), lambda i: F.struct(i.cast("long").alias("frame"), F.aggregate(F.slice("x", i * 8 + 1, 8), F.lit(0.0), lambda a, v: a + v * v).alias("energy")))
    return e.select("vec_id", F.explode(frames).alias("f")).select("vec_id", "f.frame", F.round("f.energy", 6).alias("energy"))


FRAME_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, unnest(range(8)) AS frame FROM embeddings)
SELECT vec_id, frame, round(list_sum([v * v FOR v IN x[frame * 8 + 1 : frame * 8 + 8]]), 6) AS energy FROM e"""


def wav_metrics(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.flatten(F.array_repeat("embedding", 40)).alias("samples"))
    m = signal.measure_arrays(e, "vec_id", "samples")
    return m.select("vec_id", "duration_s", F.round("peak", 4).alias("peak"), F.round("rms", 4).alias("rms"), F.round("max_step", 3).alias("max_step"), "error")


WAV_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), m AS (SELECT vec_id, len(x) AS n, list_max([abs(v) FOR v IN x]) AS peak, sqrt(list_sum([v * v FOR v IN x]) / len(x)) AS rms,
  list_max([abs(x[i] - x[i % len(x) + 1]) FOR i IN range(1, len(x) + 1)]) AS step FROM e)
SELECT vec_id, 40 * n / 8000.0::DOUBLE AS duration_s, round(peak, 4) AS peak, round(rms, 4) AS rms, round(step / greatest(rms, 1e-8), 3) AS max_step, NULL::VARCHAR AS error FROM m"""


NAMES = (
    "dedup_with_provenance DEDUP", "conflict_detection CONFLICT", "field_difference_set FIELDS", "multi_match_resolution MULTI", "duplicate_keys DUP", "last_wins LAST", "tolerance_conflicts TOLERANCE", "hash_compare HASH",
    "update_join UPDATE", "left_lookup_default LOOKUP", "semi_join_selection SEMI", "anti_join_missing ANTI", "set_equality_diff SET", "merge_with_policy MERGE", "overlay_precedence OVERLAY", "fallback_union FALLBACK",
    "term_min_example TERM", "coverage_report COVERAGE", "fixed_domain_counts DOMAIN", "top_n_per_group TOP", "running_index_in_group INDEX", "systematic_sample SAMPLE", "top_k_preselect PRESELECT", "ecdf_percentile ECDF",
    "ecdf_vs_baseline BASELINE", "priority_bands BANDS", "robust_z_global ROBUST", "robust_z_group GROUP_Z", "tercile_bands TERCILE", "percentile_summary PERCENTILE", "paired_version_delta PAIRED", "best_attempt ATTEMPT",
    "risk_score RISK", "identity_scores IDENTITY", "duration_plan PLAN", "term_priorities TERMS", "running_offset OFFSET", "batch_plan BATCH", "k_of_n_edges EDGES", "runs_islands RUNS", "bridge_gaps BRIDGE", "blips BLIPS",
    "wav_metrics WAV", "run_counts COUNT", "first_difference DIFF", "array_signal_metrics ARRAY", "frame_energy FRAME",
)
QUERIES = {n.split()[0]: globals()[n.split()[0]] for n in NAMES}
ORACLE_SQL = {n.split()[0]: globals()[n.split()[1] + "_SQL"] for n in NAMES}
