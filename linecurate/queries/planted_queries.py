"""Line audits over the documents' own words, with sounds, gender, names and fragments planted between them; the SQL works the answer out from the same words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import portuguese as P
from ..functions import text as T
from ..operators import classify
from ..plans import prepare
from .text_queries import FOLD_SQL


def _worded(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, w, a, b): a document's words of six letters or more, its first three and its next three (nada, if there are none)."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "n_chars", words.alias("w"))
    part = lambda i: F.coalesce(F.nullif(F.array_join(F.slice("w", i, 3), " "), F.lit("")), F.lit("nada"))
    return docs.select("doc_id", "text", "n_chars", "w", part(1).alias("a"), part(4).alias("b"))


_WORDED_SQL = """
d AS (SELECT doc_id, text, n_chars, regexp_extract_all(lower(text), '[a-z]{6,}') AS w FROM documents),
l AS (SELECT *, coalesce(nullif(array_to_string(w[1:3], ' '), ''), 'nada') AS a, coalesce(nullif(array_to_string(w[4:6], ' '), ''), 'nada') AS b FROM d)"""


def _by(n: int, *texts: Column) -> Column:
    out = None
    for i, text in enumerate(texts):
        out = F.when(F.col("doc_id") % n == i, text) if out is None else out.when(F.col("doc_id") % n == i, text)
    return out


def _say(*parts: str) -> Column:
    """A text of these parts; a and b stand for the columns."""
    return F.concat(*[F.col(p) if p in ("a", "b") else F.lit(p) for p in parts])


def planted_sounds(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents' words with sounds and marked actions, cleaned."""
    line = _by(4, _say("a", ", argh, ", "b", "."), _say("*Suspira* ", "a", " *", "b", "*."), _say("a", "-- tsc, ", "b"), _say("a", "."))
    out = _worded(spark, d).select("doc_id", P.without_sounds(line).alias("v"))
    return out.select("doc_id", F.col("v.text").alias("text"), F.array_join("v.notes", "; ").alias("notes"))


SOUNDS_SQL = f"""
WITH {_WORDED_SQL}
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN a || ', ' || b || '.' WHEN 1 THEN a || ' ' || b || '.' WHEN 2 THEN a || '... ' || upper(left(b, 1)) || substr(b, 2) ELSE a || '.' END AS text,
  CASE doc_id % 4 WHEN 0 THEN 'vocalização escrita removida: argh' WHEN 1 THEN 'ação removida: Suspira; marcação removida, texto preservado: ' || b WHEN 2 THEN 'vocalização escrita removida: tsc' ELSE '' END AS notes FROM l"""


def planted_gender(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents' words with first-person cues and without, in feminine."""
    line = _by(5, _say("a", ". Estou cansado, ", "b", "."), _say("Eu mesmo ", "a", "."), _say("a", ": Sou um bruxo ", "b", "."), _say("a", " cansado ", "b"), _say("Fiquei PRONTO e acho que estava perdido ", "a"))
    out = _worded(spark, d).select("doc_id", P.feminine(line).alias("g"))
    return out.select("doc_id", F.col("g.text").alias("text"), F.array_join("g.notes", "; ").alias("notes"))


GENDER_SQL = f"""
WITH {_WORDED_SQL}
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN a || '. Estou cansada, ' || b || '.' WHEN 1 THEN 'Eu mesma ' || a || '.' WHEN 2 THEN a || ': Sou uma bruxa ' || b || '.' WHEN 3 THEN a || ' cansado ' || b ELSE 'Fiquei PRONTA e acho que estava perdida ' || a END AS text,
  CASE doc_id % 5 WHEN 0 THEN 'cansado→cansada após gatilho de primeira pessoa' WHEN 1 THEN 'mesmo→mesma em autorreferência explícita' WHEN 2 THEN 'bruxo→bruxa após gatilho de primeira pessoa' WHEN 3 THEN ''
    ELSE 'PRONTO→PRONTA após gatilho de primeira pessoa; perdido→perdida após gatilho de primeira pessoa' END AS notes FROM l"""


def _planted_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = _worded(spark, d)
    text = _by(6, _say("a", ", argh, ", "b", ". Estou pronto."), _say("a", " o amiga ", "b"), _say("a", " ", "b"), _say("a", "; ", "b"), _say("Argh!"), _say("a", "."))
    original = F.when(F.col("doc_id") % 6 == 5, _say("*Cof* ", "a", ".")).otherwise(text)
    action = F.when(F.col("doc_id") % 11 == 0, "usar_original").otherwise(" Gerar ")
    lines = rows.select(F.col("doc_id").alias("ident"), action.alias("action"), original.alias("original"), text.alias("text"))
    own = lambda r: rows.where(F.col("doc_id") % 6 == r).select(F.col("doc_id").alias("ident"), F.lit(1).alias("seq"), F.col("b").alias("old"), F.concat(F.lit("sim "), "b").alias("new"))
    return prepare.audit_findings(lines, own(3), own(2).select("ident", "old", "new", F.lit("ouvir antes").alias("note")))


def planted_audit(spark: SparkSession, d: str) -> DataFrame:
    """All findings of lines of the documents' words, with edits and reviews of their own words."""
    return _planted_audit(spark, d).select("ident", F.col("seq").cast("long").alias("seq"), "category", "priority", "action", "after", "note")


_AUDIT_SQL = f"""
WITH {_WORDED_SQL},
t AS (SELECT doc_id AS ident, doc_id % 6 AS r, doc_id % 11 <> 0 AS act, a, b FROM l)
SELECT ident, 0::BIGINT AS seq, 'marcacao_ja_tratada' AS category, 'informativa' AS priority, 'nenhuma' AS action, a || '.' AS after, 'marcação removida na preparação: Cof' AS note FROM t WHERE r = 5
UNION ALL SELECT ident, 1, 'vocalizacao_ou_acao', 'alta', 'gerar', a || ', ' || b || '. Estou pronto.', 'vocalização escrita removida: argh' FROM t WHERE r = 0 AND act
UNION ALL SELECT ident, 1, 'vocalizacao_ou_acao', 'alta', 'usar_original', '', 'vocalização escrita removida: Argh; fala sem conteúdo verbal restante' FROM t WHERE r = 4 AND act
UNION ALL SELECT ident, 2, 'concordancia_feminina', 'alta', 'gerar', a || ', ' || b || '. Estou pronta.', 'pronto→pronta após gatilho de primeira pessoa' FROM t WHERE r = 0 AND act
UNION ALL SELECT ident, 2, 'concordancia_feminina', 'alta', 'gerar', replace(a || '; ' || b, b, 'sim ' || b), b || '→sim ' || b || ' (contexto confirmado por ID)' FROM t WHERE r = 3 AND act
UNION ALL SELECT ident, 3, 'concordancia_contextual', 'media', 'revisar', replace(a || ' ' || b, b, 'sim ' || b), 'ouvir antes' FROM t WHERE r = 2 AND act
UNION ALL SELECT ident, 4, 'concordancia_suspeita', 'media', 'revisar', '', 'artigo ou possessivo masculino antes de termo feminino' FROM t WHERE r = 1 AND act"""


def planted_fixes(spark: SparkSession, d: str) -> DataFrame:
    """The automatic fixes that these findings come to."""
    return prepare.safe_fixes(_planted_audit(spark, d))


FIXES_SQL = f"""
WITH f AS ({_AUDIT_SQL})
SELECT ident, arg_max(action, seq) AS action, arg_max(after, seq) AS text, string_agg(note, ' | ' ORDER BY seq) AS reason FROM f WHERE action IN ('gerar', 'usar_original') GROUP BY ident"""


def planted_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of two of the documents' words in lines of the others; a name counts if its words are mostly capitalised in all lines."""
    name = F.concat_ws(" ", F.initcap(F.get("w", F.lit(6))), F.initcap(F.get("w", F.lit(7))))
    line = F.when((F.size("w") >= 8) & (F.col("doc_id") % 3 < 2), F.concat("a", F.lit(" viu "), name, F.lit(" e "), "b")).otherwise(F.concat(F.lit("nada "), "a"))
    out = prepare.name_statistics(_worded(spark, d).select("doc_id", line.alias("line")), "doc_id", "line")
    return out.withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


NAMES_SQL = f"""
WITH {_WORDED_SQL},
n AS (SELECT *, len(w) >= 8 AND doc_id % 3 < 2 AS named FROM l),
tokens AS (
  SELECT unnest(CASE WHEN named THEN list_concat(string_split(a, ' '), string_split(b, ' '), ['viu', 'e']) ELSE list_concat(string_split(a, ' '), ['nada']) END) AS part, false AS capital FROM n
  UNION ALL SELECT w[7], true FROM n WHERE named UNION ALL SELECT w[8], true FROM n WHERE named),
shares AS (SELECT part, count(*) FILTER (WHERE capital)::DOUBLE / count(*) AS share FROM tokens GROUP BY part),
names AS (SELECT doc_id, w[7] AS x, w[8] AS y FROM n WHERE named)
SELECT upper(left(x, 1)) || substr(x, 2) || ' ' || upper(left(y, 1)) || substr(y, 2) AS name, count(*) AS lines, round(min(least(p.share, q.share)), 4) AS ratio, true AS inside,
  array_to_string(list_slice(list_sort(list(doc_id)), 1, 5), ',') AS examples
FROM names JOIN shares p ON p.part = x JOIN shares q ON q.part = y GROUP BY x, y HAVING min(least(p.share, q.share)) >= 0.68"""


_FRAGMENTS = tuple(f for some in classify.CASCADE.values() for f in some)


def planted_styles(spark: SparkSession, d: str) -> DataFrame:
    """Styles of lines that begin with a fragment of the cascade or none, of lengths and durations that reach its limits."""
    n = len(_FRAGMENTS) + 5
    fragment = F.coalesce(F.get(F.array(*map(F.lit, _FRAGMENTS)), (F.col("doc_id") % n).cast("int")), F.lit(""))
    line = F.concat(fragment, F.lit(" "), F.substr("text", F.lit(1), (F.lit(10) + F.col("doc_id") % 170).cast("int")))
    lines = _worded(spark, d).select("doc_id", line.alias("line"), (F.col("doc_id") % 37 / 4).alias("seconds"))
    return lines.select("doc_id", classify.cascade(F.col("line"), T.text_markers(F.col("line")), F.col("seconds")).alias("s")).select("doc_id", "s.style", "s.confidence")


def _styles_sql() -> str:
    has = lambda k: " OR ".join(f"contains(folded, '{f}')" for f in classify.CASCADE[k])
    picked = f"coalesce(list_extract([{', '.join(repr(f) for f in _FRAGMENTS)}], (doc_id % {len(_FRAGMENTS) + 5} + 1)::INT), '')"
    return f"""
WITH l AS (SELECT doc_id, {picked} || ' ' || left(text, (10 + doc_id % 170)::INT) AS line, doc_id % 37 / 4 AS seconds FROM documents),
t AS (SELECT doc_id, seconds, {FOLD_SQL.format('line')} AS folded, contains(line, '?') AS ask, contains(line, '!') AS cry, regexp_matches(line, '\\.\\.\\.|…') AS dots,
  len(regexp_extract_all(line, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS n FROM l),
s AS (SELECT doc_id, CASE WHEN {has('ironia_seca')} THEN 'ironia_seca' WHEN {has('confronto_firme')} THEN 'confronto_firme' WHEN n >= 25 OR seconds >= 8 THEN 'narrativa_contida'
  WHEN {has('investigacao_observacional')} THEN 'investigacao_observacional' WHEN cry OR (ask AND n <= 3) OR (ask AND dots AND n <= 6) THEN 'alerta_tenso'
  WHEN ask THEN 'pergunta_cautelosa' ELSE 'conversa_neutra' END AS style FROM t)
SELECT doc_id, style, CASE WHEN style IN ('alerta_tenso', 'pergunta_cautelosa', 'conversa_neutra') THEN 'media' ELSE 'alta' END AS confidence FROM s"""


QUERIES = {
    "planted_sounds": planted_sounds, "planted_gender": planted_gender, "planted_audit": planted_audit, "planted_fixes": planted_fixes, "planted_names": planted_names, "planted_styles": planted_styles,
}
ORACLE_SQL = {
    "planted_sounds": SOUNDS_SQL, "planted_gender": GENDER_SQL, "planted_audit": _AUDIT_SQL, "planted_fixes": FIXES_SQL, "planted_names": NAMES_SQL, "planted_styles": _styles_sql(),
}
