"""Line audits, decisions and reports, over lines whose findings are known, one for each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import portuguese as P
from ..functions import text as T
from ..operators import classify, integrity, relational
from ..plans import prepare

#: line, cleaned of sounds, its notes, in feminine, number of edits
LINES = (
    ("Argh. Estou pronto.", "Estou pronto.", "vocalização escrita removida: Argh", "Argh. Estou pronta.", 1),
    ("*Suspira* Eu mesmo vi o *lobo* ali.", "Eu mesmo vi o lobo ali.", "ação removida: Suspira; marcação removida, texto preservado: lobo", "*Suspira* Eu mesma vi o *lobo* ali.", 1),
    ("Ugh. Cof! Tsc. Vamos, fui o primeiro.", "Vamos, fui o primeiro.", "vocalização escrita removida: Ugh, Cof, Tsc", "Ugh. Cof! Tsc. Vamos, fui o primeiro.", 0),
    ("Ela é, argh, minha amiga.", "Ela é, minha amiga.", "vocalização escrita removida: argh", "Ela é, argh, minha amiga.", 0),
    ("Aaargh! Urgh!", "", "vocalização escrita removida: Aaargh, Urgh", "Aaargh! Urgh!", 0),
    ("Sou um bruxo e ando cansado.", "Sou um bruxo e ando cansado.", "", "Sou uma bruxa e ando cansada.", 2),
    ("Vi o bruxa na vila .", "Vi o bruxa na vila.", "", "Vi o bruxa na vila .", 0),
    ("Já vou-- tsc, tanto faz", "Já vou... Tanto faz", "vocalização escrita removida: tsc", "Já vou-- tsc, tanto faz", 0),
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _pick(values: Sequence) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values)).cast("int") + 1)


def _sql_pick(values: Sequence) -> str:
    return "list_extract([" + ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values) + f"], (doc_id % {len(values)} + 1)::INT)"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def vocal_clean(spark: SparkSession, d: str) -> DataFrame:
    """Each document's line, with its number after it, without sounds; and the line in feminine."""
    lines = _docs(spark, d).select("doc_id", _pick([x[0] for x in LINES]).alias("line"), F.col("text").isNotNull().alias("there"))
    out = lines.select("doc_id", P.without_sounds(F.concat("line", F.lit(" Número "), "doc_id", F.lit("."))).alias("v"), P.feminine(F.col("line")).alias("g"), "there")
    return out.select("doc_id", F.col("v.text").alias("text"), F.array_join("v.notes", "; ").alias("notes"), F.col("g.text").alias("fem"), F.size("g.notes").cast("long").alias("edits"), "there")


VOCAL_SQL = f"""
SELECT doc_id, trim({_sql_pick([x[1] for x in LINES])} || ' Número ' || doc_id || '.') AS text, {_sql_pick([x[2] for x in LINES])} AS notes, {_sql_pick([x[3] for x in LINES])} AS fem,
  {_sql_pick([x[4] for x in LINES])}::BIGINT AS edits, text IS NOT NULL AS there FROM documents"""


def _audited(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d).select("doc_id")
    action, line = F.when(F.col("doc_id") % 11 == 0, "usar_original").otherwise(" Gerar "), _pick([x[0] for x in LINES])
    lines = docs.select(F.col("doc_id").alias("ident"), action.alias("action"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("*Cof* "), F.regexp_replace(line, "[*]", ""))).otherwise(line).alias("original"), line.alias("text"))
    edits = docs.where(f"doc_id % {len(LINES)} = 0 and doc_id % 3 = 0").select(F.col("doc_id").alias("ident"), F.lit(1).alias("seq"), F.lit("Estou").alias("old"), F.lit("Sempre estou").alias("new"))
    reviews = docs.where(f"doc_id % {len(LINES)} = 3 and doc_id % 3 = 0").select(F.col("doc_id").alias("ident"), F.lit("minha amiga").alias("old"), F.lit("meu amigo").alias("new"), F.lit("pedir contexto").alias("note"))
    return prepare.audit_findings(lines, edits, reviews)


def audit_lines(spark: SparkSession, d: str) -> DataFrame:
    """All findings of each line, with its own edits and reviews."""
    return _audited(spark, d).select("ident", F.col("seq").cast("long").alias("seq"), "category", "priority", "action", "after", "note")


def _audit_sql() -> str:
    n = len(LINES)
    marked = [str("*" in x[0]).lower() for x in LINES]
    clean, notes = _sql_pick([x[1] for x in LINES]), _sql_pick([x[2] for x in LINES])
    fem = ["Estou pronta.", "Eu mesma vi o lobo ali.", "", "", "", "Sou uma bruxa e ando cansada.", "", ""]
    words = ["pronto→pronta após gatilho de primeira pessoa", "mesmo→mesma em autorreferência explícita", "", "", "", "bruxo→bruxa após gatilho de primeira pessoa; cansado→cansada após gatilho de primeira pessoa", "", ""]
    return f"""
WITH l AS (SELECT doc_id AS ident, doc_id, {_sql_pick([x[0] for x in LINES])} AS line, {clean} AS clean, {notes} AS notes, {_sql_pick(fem)} AS fem, {_sql_pick(words)} AS words,
  doc_id % 11 <> 0 AS on_, doc_id % {n} = 0 AND doc_id % 3 = 0 AS own, list_extract([{', '.join(marked)}], (doc_id % {n} + 1)::INT) AS marked FROM documents)
SELECT ident, 0::BIGINT AS seq, 'marcacao_ja_tratada' AS category, 'informativa' AS priority, 'nenhuma' AS action, line AS after, 'marcação removida na preparação: Cof' AS note FROM l WHERE doc_id % 5 = 0 AND NOT marked
UNION ALL SELECT ident, 1, 'vocalizacao_ou_acao', 'alta', CASE WHEN clean = '' THEN 'usar_original' ELSE 'gerar' END, clean, notes || CASE WHEN clean = '' THEN '; fala sem conteúdo verbal restante' ELSE '' END FROM l WHERE on_ AND notes <> ''
UNION ALL SELECT ident, 2, 'concordancia_feminina', 'alta', 'gerar', CASE WHEN own THEN 'Sempre estou pronta.' ELSE fem END, CASE WHEN own THEN 'Estou→Sempre estou (contexto confirmado por ID); ' ELSE '' END || words FROM l WHERE on_ AND words <> ''
UNION ALL SELECT ident, 3, 'concordancia_contextual', 'media', 'revisar', replace(line, 'minha amiga', 'meu amigo'), 'pedir contexto' FROM l WHERE on_ AND doc_id % {n} = 3 AND doc_id % 3 = 0
UNION ALL SELECT ident, 4, 'concordancia_suspeita', 'media', 'revisar', '', 'artigo ou possessivo masculino antes de termo feminino' FROM l WHERE on_ AND doc_id % {n} = 6"""


def safe_fixes(spark: SparkSession, d: str) -> DataFrame:
    """The automatic fix of each line that its findings come to."""
    return prepare.safe_fixes(_audited(spark, d))


def _fixes_sql() -> str:
    return f"""
WITH f AS ({_audit_sql()})
SELECT ident, arg_max(action, seq) AS action, arg_max(after, seq) AS text, string_agg(note, ' | ' ORDER BY seq) AS reason FROM f WHERE action IN ('gerar', 'usar_original') GROUP BY ident"""


def gender_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Rules of all kinds on lines that have them; flagged lines without rules are approved."""
    docs = _docs(spark, d)
    lines = docs.select(F.col("doc_id").alias("ident"), F.concat(F.lit("Obrigado, sou um bruxo. Eu mesmo, nº "), "doc_id", F.lit(".")).alias("text"), F.when(F.col("doc_id") % 4 == 0, "revisar_genero").otherwise("").alias("flag"))
    rules = [(0, "word?", "obrigado", "obrigada"), (1, "literal?", "um bruxo", "uma bruxa"), (2, "literal?", "bruxo ", "x"), (3, "word", "mesmo", "mesma"), (4, "literal", "Eu mesma", "Sim, eu mesma")]
    ruled = docs.where("doc_id % 3 = 0").select(F.col("doc_id").alias("ident"), F.explode(F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(k).alias("kind"), F.lit(a).alias("old"), F.lit(b).alias("new")) for i, k, a, b in rules])).alias("r")).select("ident", "r.*")
    reasons = docs.where("doc_id % 40 = 0").select(F.col("doc_id").alias("ident"), F.lit("Só os asteriscos saíram.").alias("reason"))
    gone = docs.where("doc_id % 25 = 7").select(F.col("doc_id").alias("ident"), F.lit("Fora dos pacotes.").alias("reason"))
    return prepare.gender_decisions(lines, ruled, reasons, gone)


DECISIONS_SQL = f"""
WITH l AS (SELECT doc_id AS ident, 'Obrigado, sou um bruxo. Eu mesmo, nº ' || doc_id || '.' AS original, CASE WHEN doc_id % 4 = 0 THEN 'revisar_genero' ELSE '' END AS flag, doc_id % 3 = 0 AS ruled, doc_id % 25 = 7 AS gone, doc_id % 40 = 0 AS own FROM documents)
SELECT ident, CASE WHEN gone THEN 'usar_original' WHEN ruled THEN 'corrigido' ELSE 'aprovado_sem_alteracao' END AS classification, CASE WHEN gone THEN 'usar_original' ELSE 'gerar' END AS action, original,
  CASE WHEN gone THEN '' WHEN ruled THEN 'Obrigada, sou uma bruxa. Sim, eu mesma, nº ' || ident || '.' ELSE original END AS final,
  CASE WHEN gone THEN 'Fora dos pacotes.' WHEN own THEN 'Só os asteriscos saíram.' WHEN ruled THEN {_text(prepare.CHANGED)} || 'obrigado→obrigada; um bruxo→uma bruxa; mesmo→mesma; Eu mesma→Sim, eu mesma.' ELSE {_text(prepare.APPROVED)} END AS reason, flag
FROM l WHERE flag <> '' OR ruled OR gone"""


#: line, and the names in it
NAMED = (
    ("Eu vi Ana de Castro e o Pedro.", ("Ana de Castro", "Pedro")), ("A Torre Negra caiu. Torre alta, disse Pedro.", ("Torre Negra", "Torre", "Pedro")), ("nada aqui, só vento.", ()), ("Vento forte. Encontrei Jan, van Eyck.", ("Encontrei Jan van Eyck",)),
    ("Lá vai D’Ávila com Pedro.", ("D'Ávila", "Pedro")),
)


def proper_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in each document's line; five lines of each as examples."""
    return prepare.name_statistics(_docs(spark, d).select("doc_id", _pick([x[0] for x in NAMED]).alias("line")), "doc_id", "line").withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


def _names_sql() -> str:
    # Torre is capitalised wherever it stands, Vento in one of two lines, Encontrei opens its sentence only
    ratio = {"Ana de Castro": 1.0, "Pedro": 1.0, "Torre Negra": 1.0, "Torre": 1.0, "D'Ávila": 1.0, "Encontrei Jan van Eyck": 1.0}
    rows = ", ".join(f"({i}, {_text(n)}, {ratio[n]}::DOUBLE)" for i, (_, names) in enumerate(NAMED) for n in names)
    return f"""
WITH n(k, name, ratio) AS (VALUES {rows}), o AS (SELECT name, ratio, doc_id FROM n JOIN documents ON doc_id % {len(NAMED)} = k)
SELECT name, count(*) AS lines, min(ratio) AS ratio, true AS inside, array_to_string(list_slice(list_sort(list(doc_id)), 1, 5), ',') AS examples FROM o GROUP BY name"""


def term_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Whole-term matches by a pattern made from a column."""
    terms = F.element_at(F.array(F.lit("the"), F.lit("a.b"), F.lit("de")), (F.col("doc_id") % 3).cast("int") + 1)
    return _docs(spark, d).select("doc_id", terms.alias("term"), F.rlike(F.regexp_replace("text", "[^A-Za-z ]", " "), T.word_pattern(terms)).alias("found"))


PATTERNS_SQL = """
WITH t AS (SELECT doc_id, list_extract(['the', 'a.b', 'de'], (doc_id % 3 + 1)::INT) AS term, ' ' || lower(regexp_replace(text, '[^A-Za-z ]', ' ', 'g')) || ' ' AS line FROM documents)
SELECT doc_id, term, contains(line, ' ' || term || ' ') AS found FROM t"""


def style_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions on every seventh row; the reference's state follows the final style of all."""
    docs = _docs(spark, d)
    rows = docs.select(F.col("doc_id").alias("ident"), _pick(classify.STYLES).alias("style"), F.lit("baixa").alias("confidence"), F.lit("sim").alias("review"), F.lit("alta").alias("priority"), F.lit("regras").alias("origin"), "lang")
    made = docs.where("doc_id % 7 = 0").select(F.col("doc_id").alias("ident"), F.lit("tristeza_contida").alias("style"), F.when(F.col("doc_id") % 2 == 0, "alta").otherwise(" ").alias("confidence"), F.lit("ouvido").alias("reason"))
    return relational.apply_decisions(rows, made, classify.STYLES)


STYLE_DECISIONS_SQL = f"""
WITH s AS (SELECT doc_id AS ident, {_sql_pick(classify.STYLES)} AS old, lang, doc_id % 7 = 0 AS on_, doc_id % 2 = 0 AS even FROM documents), f AS (SELECT *, CASE WHEN on_ THEN 'tristeza_contida' ELSE old END AS style FROM s)
SELECT ident, style, CASE WHEN NOT on_ THEN 'baixa' WHEN even THEN 'alta' ELSE 'media' END AS confidence, CASE WHEN on_ THEN 'não' ELSE 'sim' END AS review, CASE WHEN on_ THEN 'nenhuma' ELSE 'alta' END AS priority,
  CASE WHEN on_ THEN 'decisao_contextual_final' ELSE 'regras' END AS origin, lang, CASE WHEN on_ THEN 'ouvido' END AS reason,
  CASE WHEN style IN ('combate_agressivo', 'tristeza_contida') THEN 'prompt_criado_teste_pendente' ELSE 'aprovada_piloto' END AS reference_status FROM f"""


def sample_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality of lines as samples of their style, of those whose duration and length make them eligible."""
    e = spark.read.parquet(f"{d}/events.parquet")
    style, count = F.when(F.col("event_id") % 3 == 0, "narrativa_contida").otherwise("alerta_tenso"), F.col("event_id") % 30
    rows = e.select("event_id", style.alias("style"), (F.floor(F.col("value") * 2) / 100).alias("score"), (F.floor(F.col("value")) / 90).alias("margin"), (F.col("value") / 25).alias("seconds"), count.alias("words"))
    out = rows.where(classify.sample_eligible(F.col("style"), F.col("seconds"), F.col("words")))
    return out.select("event_id", F.round(classify.candidate_quality(F.col("style"), F.col("score"), F.col("margin"), F.col("seconds"), F.col("words")), 6).alias("quality"))


QUALITY_SQL = """
WITH r AS (SELECT event_id, event_id % 3 = 0 AS n, floor(value * 2) / 100 AS s, floor(value) / 90 AS m, value / 25 AS t, event_id % 30 AS w FROM events)
SELECT event_id, round(s + m + greatest(0, 3 - abs(t - CASE WHEN n THEN 9 ELSE 4 END) * 0.45::DOUBLE) + CASE WHEN w BETWEEN 5 AND 22 THEN 1.5 ELSE 0 END, 6) AS quality
FROM r WHERE t >= 1.2 AND t <= CASE WHEN n THEN 14 ELSE 7.5 END AND w >= 4"""


def wanted_places(spark: SparkSession, d: str) -> DataFrame:
    """Where each wanted order line is taken from, counted by state."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    places = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ident"), F.col("l_suppkey").alias("variant"), "l_partkey", "l_extendedprice", "l_returnflag", (F.col("l_quantity") > 49).alias("bad"))
    wanted = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_orderkey") * 10 + 1 + F.col("o_orderkey") % 9).alias("ident"))
    out = integrity.wanted_status(wanted, places, "ident", "variant", ["l_partkey", "variant", "l_extendedprice"], ["l_returnflag"], "bad")
    return out.groupBy("status").agg(F.count("*").alias("n"), F.sum("rows").alias("places"), F.sum("chosen.l_partkey").alias("parts"))


WANTED_SQL = """
WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS ident, * FROM lineitem), w AS (SELECT DISTINCT o_orderkey * 10 + 1 + o_orderkey % 9 AS ident FROM orders),
g AS (SELECT ident, count(*) AS n, bool_or(l_quantity > 49) AS bad, count(DISTINCT l_returnflag) AS kinds, max(l_partkey) AS part FROM p GROUP BY ident),
s AS (SELECT CASE WHEN n IS NULL THEN 'ausente' WHEN bad THEN 'erro' WHEN kinds > 1 THEN 'duplicado_divergente' WHEN n > 1 THEN 'duplicado_resolvido' ELSE 'ok' END AS status, n, part FROM w LEFT JOIN g USING (ident))
SELECT status, count(*) AS n, sum(coalesce(n, 0))::BIGINT AS places, sum(CASE WHEN status IN ('ok', 'duplicado_resolvido') THEN part END)::BIGINT AS parts FROM s GROUP BY status"""


STATES = ("ok", "duplicado_equivalente", "id_high_expandido", "ausente", "duplicado_divergente", "incompatível", "erro", "ignorado")


def mapping_summary(spark: SparkSession, d: str) -> DataFrame:
    """Counts by state, changes of duration and the archive's size, over all order lines."""
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    state = F.element_at(F.array(*map(F.lit, STATES)), (F.col("l_partkey") % 8).cast("int") + 1)
    mapped = li.select(state.alias("status"), F.when(F.col("l_partkey") % 8 == 2, 2).otherwise(1).alias("entries"), (F.col("l_discount") * 100 - 5).alias("delta_pct"), (F.col("l_orderkey") * 7).alias("media_bytes"), F.col("l_linenumber").cast("long").alias("aside_bytes"))
    out = integrity.mapping_summary(mapped)
    return out.withColumns({"least_delta": F.round("least_delta", 6), "most_delta": F.round("most_delta", 6)})


MAPPING_SQL = """
WITH m AS (SELECT l_partkey % 8 AS s, CASE WHEN l_partkey % 8 = 2 THEN 2 ELSE 1 END AS e, l_discount * 100 - 5 AS delta, l_orderkey * 7 + l_linenumber + 12 AS b FROM lineitem),
a AS (SELECT count(*) FILTER (WHERE s < 3) AS compatible, sum(e) FILTER (WHERE s < 3)::BIGINT AS entries, count(*) FILTER (WHERE s = 3) AS missing, count(*) FILTER (WHERE s = 1) AS duplicates, count(*) FILTER (WHERE s = 2) AS expanded,
  count(*) FILTER (WHERE s = 4) AS divergent, count(*) FILTER (WHERE s IN (5, 6)) AS incompatible, count(*) FILTER (WHERE s = 7) AS ignored, round(min(delta) FILTER (WHERE s < 3), 6) AS least_delta, round(max(delta) FILTER (WHERE s < 3), 6) AS most_delta,
  sum(e * b) FILTER (WHERE s < 3) AS payload FROM m)
SELECT * EXCLUDE payload, (payload + 12 + 40 * entries + CASE WHEN entries < 64 THEN 1 WHEN entries < 8192 THEN 2 WHEN entries < 1048576 THEN 3 ELSE 4 END)::BIGINT AS bytes FROM a"""


def _orders_as_lines(spark: SparkSession, d: str) -> DataFrame:
    """Coverage labels of orders: recorded if they have lines, packed if their customer is in debt or their key is odd."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("ident"), "o_orderstatus", "o_custkey")
    manifest = o.where("ident % 13 <> 0").select("ident", F.when(F.col("ident") % 10 == 0, "usar_original").otherwise("gerar").alias("action"), F.when(F.col("ident") % 50 == 1, "revisar_genero").otherwise(" ").alias("review"))
    recorded = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("ident")).distinct()
    packed = o.where("ident % 2 = 1").select("ident")
    mapping = o.where("ident % 17 <> 0").select("ident", F.when(F.col("o_orderstatus") == "P", "erro").otherwise("ok").alias("status"))
    return integrity.coverage_labels(manifest, recorded, packed, mapping, mapping.limit(0))


NAMES = ("gerar", "usar_original", "revisao_pendente", "wav_faltando", "wem_faltando", "wav_extra", "wem_extra", "pos_processamento_invalido", "mapeamento_invalido")


def coverage_gate(spark: SparkSession, d: str) -> DataFrame:
    """The coverage report, and whether each name of it holds up the gate."""
    labels = _orders_as_lines(spark, d)
    report = integrity.coverage(labels, "ident", "categoria", NAMES)
    blocks = F.col("categoria").isin("wav_faltando", "wem_faltando", "mapeamento_invalido", "pos_processamento_invalido", "revisao_pendente")
    return report.withColumn("blocks", blocks & (F.col("quantidade") > 0))


GATE_SQL = """
WITH m AS (SELECT o_orderkey AS k, o_orderkey % 10 = 0 AS original FROM orders WHERE o_orderkey % 13 <> 0), g AS (SELECT k FROM m WHERE NOT original), w AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), e AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 1),
p AS (SELECT o_orderkey AS k, o_orderstatus = 'P' AS bad FROM orders WHERE o_orderkey % 17 <> 0),
c(categoria, quantidade) AS (SELECT 'gerar', count(*) FROM g UNION ALL SELECT 'usar_original', count(*) FROM m WHERE original UNION ALL SELECT 'revisao_pendente', count(*) FROM m WHERE k % 50 = 1
  UNION ALL SELECT 'wav_faltando', count(*) FROM g WHERE k NOT IN (SELECT k FROM w) UNION ALL SELECT 'wem_faltando', count(*) FROM g WHERE k NOT IN (SELECT k FROM e) UNION ALL SELECT 'wav_extra', count(*) FROM w WHERE k NOT IN (SELECT k FROM g)
  UNION ALL SELECT 'wem_extra', count(*) FROM e WHERE k NOT IN (SELECT k FROM g) UNION ALL SELECT 'pos_processamento_invalido', 0 UNION ALL SELECT 'mapeamento_invalido', count(*) FROM g LEFT JOIN p USING (k) WHERE coalesce(bad, true))
SELECT categoria, quantidade, quantidade > 0 AND (categoria LIKE '%faltando' OR categoria LIKE '%invalido' OR categoria = 'revisao_pendente') AS blocks FROM c"""


def payload_check(spark: SparkSession, d: str) -> DataFrame:
    """Entries that differ from their source, of customers that were written with some changes."""
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.encode("c_name", "utf-8").alias("media"), F.encode("c_mktsegment", "utf-8").alias("aside"), F.col("c_acctbal").alias("seconds"))
    key = F.col("c_custkey")
    written = c.where("c_custkey % 31 <> 0").select(F.when(key % 37 == 0, -key).otherwise(key).alias("c_custkey"), F.when(key % 7 == 0, F.encode(F.lit("x"), "utf-8")).otherwise(F.col("media")).alias("media"), F.when(key % 14 == 0, F.lit(None)).otherwise(F.col("aside")).alias("aside"), (F.col("seconds") + F.when(key % 5 == 0, 0.01).otherwise(0.0005)).alias("seconds"))
    return integrity.payload_mismatches(written, c, ["c_custkey"], ["media", "aside"], {"seconds": 0.001})


PAYLOAD_SQL = """
SELECT c_custkey, 'missing' AS problem FROM customer WHERE c_custkey % 31 = 0 OR c_custkey % 37 = 0
UNION ALL SELECT -c_custkey, 'extra' FROM customer WHERE c_custkey % 31 <> 0 AND c_custkey % 37 = 0
UNION ALL SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 7 = 0 THEN 'media' END, CASE WHEN c_custkey % 14 = 0 THEN 'aside' END, CASE WHEN c_custkey % 5 = 0 THEN 'seconds' END)
  FROM customer WHERE c_custkey % 31 <> 0 AND c_custkey % 37 <> 0 AND (c_custkey % 7 = 0 OR c_custkey % 5 = 0)"""


def most_common(spark: SparkSession, d: str) -> DataFrame:
    """Words of all documents by falling count."""
    words = _docs(spark, d).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return integrity.most_common(words, "word")


COMMON_SQL = "SELECT word, count(*) AS rows FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY word"


QUERIES = {
    "vocal_clean": vocal_clean, "audit_lines": audit_lines, "safe_fixes": safe_fixes, "gender_decisions": gender_decisions, "proper_names": proper_names, "term_patterns": term_patterns, "style_decisions": style_decisions,
    "sample_quality": sample_quality, "wanted_places": wanted_places, "mapping_summary": mapping_summary, "coverage_gate": coverage_gate, "payload_check": payload_check, "most_common": most_common,
}
ORACLE_SQL = {
    "vocal_clean": VOCAL_SQL, "audit_lines": _audit_sql(), "safe_fixes": _fixes_sql(), "gender_decisions": DECISIONS_SQL, "proper_names": _names_sql(), "term_patterns": PATTERNS_SQL, "style_decisions": STYLE_DECISIONS_SQL,
    "sample_quality": QUALITY_SQL, "wanted_places": WANTED_SQL, "mapping_summary": MAPPING_SQL, "coverage_gate": GATE_SQL, "payload_check": PAYLOAD_SQL, "most_common": COMMON_SQL,
}
