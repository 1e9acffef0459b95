"""Text functions, classifiers, mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import portuguese as P
from ..functions import text as T
from ..operators import classify, integrity, lexicon, relational
from ..plans import prepare
from ..sources.tables import spread

LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
WORD = f"{LETTERS}+(?:[''’-]{LETTERS}+)?"  # for SQL, the quote doubled
#: A lexicon and cascade for the invented languages of the tables.
FRAGMENTS = {"ironia_seca": ("license", "www"), "confronto_firme": ("idiot", "stupid"), "investigacao_observacional": ("ciones", "keit", "tion")}
TABLE_LEXICON = {"investigacao_observacional": (("the*", 1.0), ("and", 1.5)), "confronto_firme": (("der", 2.0), ("un*", 1.25)), "tristeza_contida": (("de", 2.5), ("la", 0.5))}


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/documents.parquet"))


FOLD_SQL = "trim(regexp_replace(lower(strip_accents({})), '[^a-z0-9]+', ' ', 'g'))"


def hex_id_text_metrics(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return _docs(spark, d).select(
        "doc_id", T.hex_id("doc_id").alias("id_hex"), T.words(t).alias("words"), T.letters(t).alias("letters"), T.syllables(t).alias("syllables"), T.inner_punctuation(t).alias("inner_marks")
    )


HEX_SQL = f"""
SELECT doc_id, printf('0x%08x', doc_id) AS id_hex, len(regexp_extract_all(text, '{WORD}'))::BIGINT AS words, len(regexp_extract_all(text, '{LETTERS}'))::BIGINT AS letters,
  greatest(len(regexp_extract_all(text, '{WORD}')), len(regexp_extract_all(lower(text), '[aeiouáàâãéêíóôõúü]+')))::BIGINT AS syllables,
  len(regexp_extract_all(regexp_replace(text, '[.!?…\\s]+$', ''), '\\.\\.\\.|[,;:—–-]'))::BIGINT AS inner_marks
FROM documents"""


def normalized_ids(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(" 0X"), F.upper(F.substr(T.hex_id("o_orderkey"), F.lit(3))), F.lit(" "))
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.lit("0xzz")).otherwise(raw).alias("raw"))
    return o.select("o_orderkey", T.normalize_id("raw").alias("id_hex"), T.parse_ident("raw").alias("ident"))


IDS_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN printf('0x%08x', o_orderkey) END AS id_hex, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS ident FROM orders"""


def text_markers(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", T.text_markers("text").alias("markers"), T.occurrences("text", "*").alias("stars"), T.occurrences("text", "the ").alias("articles"))


MARKERS_SQL = """
SELECT doc_id, coalesce(nullif(concat_ws('|', CASE WHEN contains(text, '?') THEN 'pergunta' END, CASE WHEN contains(text, '!') THEN 'exclamacao' END,
  CASE WHEN regexp_matches(text, '\\.\\.\\.|…') THEN 'reticencias' END), ''), 'declarativa') AS markers,
  (length(text) - length(replace(text, '*', '')))::BIGINT AS stars, ((length(text) - length(replace(text, 'the ', ''))) // 4)::BIGINT AS articles
FROM documents"""


def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", T.fold("text").alias("folded"), T.normalize_term("text").alias("term"))


NORMALIZE_SQL = f"""SELECT doc_id, {FOLD_SQL.format('text')} AS folded, trim(regexp_replace(replace(text, '’', ''''), '\\s+', ' ', 'g')) AS term FROM documents"""


def clean_markup_spacing(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", T.clean_markup("text").alias("unmarked"), T.clean_spacing("text").alias("tidy"))


CLEAN_SQL = f"""
SELECT doc_id,
  regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '(?i)\\*+\\s*(?:{'|'.join(s.replace(' ', chr(92) + 's+') for s in sorted(T.NONVERBAL, key=len, reverse=True))})\\s*\\*+', '', 'g'),
    '\\*+([^*]+?)\\*+', '\\1', 'g'), '[ \\t]{{2,}}', ' ', 'g')), '^\\s*[,;:]\\s*', '') AS unmarked,
  regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '\\s+([,.;:!?…])', '\\1', 'g'), '([.!?…])({LETTERS})', '\\1 \\2', 'g'), '\\s{{2,}}', ' ', 'g')), '^[,;:]\\s*', '') AS tidy
FROM documents"""


def style_cascade_counts(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    styled = _docs(spark, d).select(classify.cascade(t, T.text_markers(t), F.lit(0.0), FRAGMENTS).alias("s"))
    return styled.groupBy("s.style", "s.confidence").agg(F.count("*").alias("lines"))


def _cascade_sql() -> str:
    has = lambda k: " OR ".join(f"contains(folded, '{f}')" for f in FRAGMENTS[k])
    return f"""
WITH t AS (SELECT {FOLD_SQL.format('text')} AS folded, contains(text, '?') AS ask, contains(text, '!') AS cry, regexp_matches(text, '\\.\\.\\.|…') AS dots,
  len(regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}_]+')) AS n FROM documents),
s AS (SELECT CASE WHEN {has('ironia_seca')} THEN 'ironia_seca' WHEN {has('confronto_firme')} THEN 'confronto_firme' WHEN n >= 25 THEN 'narrativa_contida'
  WHEN {has('investigacao_observacional')} THEN 'investigacao_observacional' WHEN cry OR (ask AND n <= 3) OR (ask AND dots AND n <= 6) THEN 'alerta_tenso'
  WHEN ask THEN 'pergunta_cautelosa' ELSE 'conversa_neutra' END AS style FROM t)
SELECT style, CASE WHEN style IN ('alerta_tenso', 'pergunta_cautelosa', 'conversa_neutra') THEN 'media' ELSE 'alta' END AS confidence, count(*) AS lines FROM s GROUP BY style"""


#: Lines that hold fragments of the lexicon, one put before each text.
SPOKEN = (
    "Há pegadas e sangue perto da caverna.", "Sinto falta dela. Descanse em paz.", "Me sinto muito bem hoje.", "Perdi tudo?", "De acordo com ele, você mente!", "Que ótimo... claro.", "Cuidado! Atrás de você!",
    "Vou te matar, morra!", "Quem é você?", "Siga o rastro até a casa.", "Não acredito em você, saia daqui.",
)


def _lexicon() -> dict:
    return {style: (*classify.LEXICON.get(style, ()), *TABLE_LEXICON.get(style, ())) for style in classify.STYLES}


def style_scored_argmax(spark: SparkSession, d: str) -> DataFrame:
    spoken = F.element_at(F.array(*map(F.lit, SPOKEN)), (F.col("doc_id") % len(SPOKEN)).cast("int") + 1)
    lines = _docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 3 == 0, spoken).otherwise(F.concat_ws(" ", spoken, "text")).alias("line"), F.when(F.col("lang") == "de", 0.0).otherwise(F.col("n_chars") / 400).alias("seconds"))
    pilot = F.when(F.col("doc_id") % 50 == 7, "ironia_seca")
    placed = classify.with_style_scores(lines, "doc_id", "line", F.col("seconds"), lexicon.table(spark, _lexicon()))
    scored = placed.select("doc_id", classify.decide(F.col("scores"), pilot).alias("x"))
    return scored.select("doc_id", "x.style", "x.second", F.round("x.top", 6).alias("top"), F.round("x.margin", 6).alias("margin"), "x.confidence", "x.review", "x.priority", "x.origin")


def _scored_sql() -> str:
    def lex(style: str) -> str:
        parts = []
        for f, w in _lexicon().get(style, ()):
            token = f.rstrip("*")
            pattern = f"(^| ){token}" + ("[a-z0-9]*" if f.endswith("*") else "") + "( |$)"
            parts.append(f"CASE WHEN regexp_matches(folded, '{pattern}') THEN {w}::DOUBLE ELSE 0 END")
        return " + ".join(parts) or "0"

    spoken = "list_extract([" + ", ".join(f"'{x}'" for x in SPOKEN) + f"], (doc_id % {len(SPOKEN)} + 1)::INT)"
    order = {s: i for i, s in enumerate(classify.STYLES)}
    return f"""
WITH l AS (SELECT doc_id, {spoken} AS spoken, text, CASE WHEN lang = 'de' THEN 0 ELSE n_chars / 400 END AS dur FROM documents),
m AS (SELECT doc_id, dur, CASE WHEN doc_id % 3 = 0 THEN spoken ELSE concat_ws(' ', spoken, text) END AS line FROM l),
t AS (SELECT doc_id, dur, {FOLD_SQL.format('line')} AS folded, contains(line, '?') AS ask, contains(line, '!') AS cry, regexp_matches(line, '\\.\\.\\.|…') AS dots,
  len(regexp_extract_all(line, '[A-Za-zÀ-ÖØ-öø-ÿ0-9]+')) AS n, greatest(1, len(regexp_extract_all(line, '[.!?]+'))) AS parts FROM m),
b AS (SELECT *, {lex('investigacao_observacional')} AS inv,
  CASE WHEN contains(folded, 'me sinto muito') THEN greatest(0, {lex('tristeza_contida')} - 4.5) ELSE {lex('tristeza_contida')} END AS sad,
  CASE WHEN contains(folded, 'de acordo com') THEN greatest(0, {lex('confronto_firme')} - 1) ELSE {lex('confronto_firme')} END AS firm FROM t),
s AS (
  SELECT doc_id, 'conversa_neutra' AS style, 1 + CASE WHEN n BETWEEN 4 AND 22 AND NOT cry THEN 0.5 ELSE 0 END AS score FROM b
  UNION ALL SELECT doc_id, 'investigacao_observacional', inv FROM b
  UNION ALL SELECT doc_id, 'pergunta_cautelosa', {lex('pergunta_cautelosa')} + CASE WHEN ask THEN 2.4 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'confronto_firme', firm + CASE WHEN ask AND firm >= 2 THEN 0.8 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'ironia_seca', {lex('ironia_seca')} + CASE WHEN dots THEN 0.4 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'narrativa_contida', {lex('narrativa_contida')} + CASE WHEN dur >= 8 THEN 2.5 + least(1.5::DOUBLE, (dur - 8) / 8.0::DOUBLE) ELSE 0 END + CASE WHEN n >= 25 THEN 3 + least(2.0::DOUBLE, (n - 25) / 18.0::DOUBLE) ELSE 0 END + CASE WHEN parts >= 3 AND n >= 18 THEN 1.2 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'alerta_tenso', {lex('alerta_tenso')} + CASE WHEN dur > 0 AND n / dur >= 8.5 THEN 0.8 ELSE 0 END + CASE WHEN ask AND n <= 4 THEN 2.0 WHEN ask AND dots AND n <= 8 THEN 1.5 ELSE 0 END + CASE WHEN cry THEN 1.5 ELSE 0 END + CASE WHEN n <= 3 AND dur <= 1.5 AND NOT ask THEN 0.8 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'combate_agressivo', {lex('combate_agressivo')} + CASE WHEN cry THEN 0.8 ELSE 0 END FROM b
  UNION ALL SELECT doc_id, 'tristeza_contida', CASE WHEN sad <= 1.2 AND inv >= 2.5 THEN sad * 0.35 ELSE sad END FROM b),
o AS (SELECT s.doc_id, s.style, s.score::DOUBLE AS score, k.i FROM s JOIN (VALUES {', '.join(f"('{s}', {i})" for s, i in order.items())}) k(style, i) ON s.style = k.style),
best AS (SELECT doc_id, max(score) AS points, arg_max(style, round(score, 9) * 1000000 - i) AS lead FROM o WHERE style <> 'conversa_neutra' GROUP BY doc_id),
pick AS (SELECT best.doc_id, points, CASE WHEN best.doc_id % 50 = 7 THEN 'ironia_seca' WHEN points < 2 THEN 'conversa_neutra' ELSE lead END AS style FROM best),
two AS (SELECT pick.doc_id, pick.style, points, max(CASE WHEN o.style = pick.style THEN score END) AS top, arg_max(o.style, CASE WHEN o.style <> pick.style THEN round(score, 9) * 1000000 - i END) AS second,
  max(CASE WHEN o.style <> pick.style THEN score END) AS next FROM pick JOIN o ON o.doc_id = pick.doc_id GROUP BY ALL),
fin AS (SELECT *, top - next AS margin, CASE WHEN points < 2 THEN CASE WHEN points < 1.5 THEN 'media' ELSE 'baixa' END WHEN top >= 5 AND top - next >= 2 THEN 'alta'
  WHEN top >= 2.3 AND top - next >= 0.70 THEN 'media' ELSE 'baixa' END AS confidence FROM two)
SELECT doc_id, style, second, CASE WHEN doc_id % 50 = 7 THEN 99 ELSE round(top, 6) END AS top, CASE WHEN doc_id % 50 = 7 THEN 99 ELSE round(margin, 6) END AS margin,
  CASE WHEN doc_id % 50 = 7 THEN 'alta' ELSE confidence END AS confidence, CASE WHEN doc_id % 50 = 7 OR p = 'nenhuma' THEN 'não' ELSE 'sim' END AS review, CASE WHEN doc_id % 50 = 7 THEN 'nenhuma' ELSE p END AS priority,
  CASE WHEN doc_id % 50 = 7 THEN 'piloto_confirmado' ELSE 'regras_semanticas_duracao' END AS origin
FROM (SELECT *, CASE WHEN points >= 2 AND margin < 0.35 THEN 'alta' WHEN points >= 2 AND confidence = 'baixa' THEN 'media' WHEN points < 2 AND points >= 1.9 THEN 'baixa' ELSE 'nenhuma' END AS p FROM fin)"""


def style_catalog_pivot(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    styled = _docs(spark, d).select(classify.cascade(t, T.text_markers(t), F.lit(0.0), FRAGMENTS).alias("s")).select("s.*")
    out = integrity.catalogue_counts(styled, "style", "confidence", classify.STYLES, ("alta", "media", "baixa"))
    return out.withColumn("share", F.round("share", 6))


def _pivot_sql() -> str:
    return f"""
WITH c AS ({_cascade_sql()}), k AS (SELECT * FROM (VALUES {', '.join(f"('{s}')" for s in classify.STYLES)}) v(style))
SELECT k.style, coalesce(sum(lines) FILTER (WHERE confidence = 'alta'), 0)::BIGINT AS alta, coalesce(sum(lines) FILTER (WHERE confidence = 'media'), 0)::BIGINT AS media,
  coalesce(sum(lines) FILTER (WHERE confidence = 'baixa'), 0)::BIGINT AS baixa, coalesce(sum(lines), 0)::BIGINT AS total,
  round(coalesce(sum(lines), 0) / greatest(1, (SELECT sum(lines) FROM c))::DOUBLE, 6) AS share
FROM k LEFT JOIN c ON c.style = k.style GROUP BY k.style"""


def acoustic_refinement(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    pick = lambda c, names: F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(c, F.lit(len(names))) + 1).cast("int"))
    i = F.col("event_id")
    df = e.select(
        "event_id", pick(i, classify.STYLES).alias("style"), pick(F.floor(i / 9), classify.STYLES).alias("second"), (F.pmod(i, F.lit(17)) / 4.0).alias("top"), (F.pmod(i, F.lit(13)) / 4.0).alias("second_score"),
        (i % 5 == 0).alias("has_cry"), pick(i, ("alta", "media", "baixa")).alias("intensity"), pick(F.floor(i / 3), ("rapido", "normal", "lento")).alias("pace"),
        pick(F.floor(i / 2), ("sem_pausa", "pausa_leve", "pausa_frequente")).alias("pauses"), pick(i, ("curta", "media", "longa")).alias("duration_band"),
    ).where("style <> second")
    return classify.refine(df).groupBy("style", "second", "style_refined", "confidence_refined", "review_refined").agg(F.count("*").alias("n"))


def _refined_sql() -> str:
    styles = ", ".join(f"'{x}'" for x in classify.STYLES)
    pick = lambda expression, names: f"list_extract([{names}], ({expression} + 1)::INT)"
    return f"""
WITH p(style, ia, im, ib, pr, pn, pl, fr, lv, sp, lo) AS (VALUES
  ('alerta_tenso', 1.5, 0.5, -0.8, 1.2, 0.2, -0.6, 0, 0, 0.5, 0), ('combate_agressivo', 1.5, 0.5, -0.8, 1.2, 0.2, -0.6, 0, 0, 0.5, 0), ('confronto_firme', 1, 0.5, -0.2, 0.7, 0.3, 0, 0, 0, 0, 0),
  ('investigacao_observacional', 0.2, 0.6, 0.8, 0, 0.6, 0.8, 1, 0.4, 0, 0), ('tristeza_contida', -0.8, 0.5, 1.4, -0.7, 0.4, 1, 0.8, 0.2, 0, 0), ('ironia_seca', 0, 0.3, 0.3, 0, 0.6, 0.8, 0.6, 0.6, 0, 0),
  ('pergunta_cautelosa', 0, 0.7, 1, 0, 0.6, 0.8, 0.4, 0.4, 0, 0), ('narrativa_contida', 0, 0, 0, 0, 0.7, 0.6, 0.6, 0.2, 0, 1.3), ('conversa_neutra', 0.1, 0.4, 0.1, 0.2, 0.5, 0.2, 0, 0, 0, 0)),
e AS (SELECT event_id AS i, {pick('event_id % 9', styles)} AS a, {pick('event_id // 9 % 9', styles)} AS b, (event_id % 17) / 4 AS top, (event_id % 13) / 4 AS next, event_id % 5 = 0 AS cry, event_id % 3 AS int_, event_id // 3 % 3 AS pace, event_id // 2 % 3 AS pause FROM events),
s AS (SELECT e.*, p.style, CASE int_ WHEN 0 THEN ia WHEN 1 THEN im ELSE ib END::DOUBLE + CASE pace WHEN 0 THEN pr WHEN 1 THEN pn ELSE pl END::DOUBLE + CASE pause WHEN 0 THEN sp WHEN 1 THEN lv ELSE fr END::DOUBLE + CASE WHEN int_ = 2 THEN lo ELSE 0 END::DOUBLE AS points FROM e JOIN p ON p.style IN (a, b) WHERE a <> b),
t AS (SELECT i, a, b, top, next, cry, int_ = 0 AS loud, pace = 0 AS quick, pause = 0 AS still, top + max(points) FILTER (WHERE style = a) AS first, next + max(points) FILTER (WHERE style = b) AS other_score FROM s GROUP BY i, a, b, top, next, cry, int_, pace, pause),
u AS (SELECT *, CASE WHEN a = 'pergunta_cautelosa' THEN b ELSE a END AS other, CASE WHEN a = 'pergunta_cautelosa' THEN next ELSE top END AS score, 'pergunta_cautelosa' IN (a, b) AS asked FROM t),
v AS (SELECT *, CASE WHEN asked AND other = 'alerta_tenso' THEN CASE WHEN cry OR loud AND (quick OR still) THEN other ELSE 'pergunta_cautelosa' END
    WHEN asked THEN CASE WHEN other IN ('investigacao_observacional', 'ironia_seca', 'narrativa_contida') AND score >= 2.4 OR other = 'confronto_firme' AND (score >= 3.2 OR loud OR quick)
      OR other = 'tristeza_contida' AND score >= 3.5 OR other = 'combate_agressivo' AND score >= 3.5 AND (loud OR quick) THEN other ELSE 'pergunta_cautelosa' END
    WHEN other_score > first + 0.6::DOUBLE THEN b ELSE a END AS refined, CASE WHEN asked OR abs(first - other_score) >= 0.45::DOUBLE THEN 'media' ELSE 'baixa' END AS sure FROM u)
SELECT a AS style, b AS second, refined AS style_refined, sure AS confidence_refined, CASE WHEN sure = 'baixa' AND abs(top - next) < 0.2::DOUBLE AND refined = a THEN 'sim' ELSE 'não' END AS review_refined, count(*) AS n FROM v GROUP BY ALL"""


def text_edits(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d).select("doc_id", "text")
    rules = spark.createDataFrame([(1, "the ", "THE "), (2, "THE of", "of the"), (3, ".", "!")], "seq int, old string, new string")
    keyed = docs.select("doc_id").join(F.broadcast(rules))
    return P.apply_rules(docs, keyed, "doc_id", "text").select("doc_id", "edited", "absent")


EDITS_SQL = """
WITH s AS (SELECT doc_id, text, replace(text, 'the ', 'THE ') AS a FROM documents), r AS (SELECT *, replace(a, 'THE of', 'of the') AS b FROM s)
SELECT doc_id, replace(b, '.', '!') AS edited, CASE WHEN NOT contains(text, 'the ') THEN 'the ' WHEN NOT contains(a, 'THE of') THEN 'THE of' WHEN NOT contains(b, '.') THEN '.' END AS absent FROM r"""


def word_replacement(spark: SparkSession, d: str) -> DataFrame:
    out = T.replace_word("text", "the", "das")
    return _docs(spark, d).select("doc_id", out.alias("edited"), (out != F.col("text")).alias("changed"), F.regexp_count("text", F.lit(r"(?iU)\bthe\b")).cast("long").alias("times"))


_W = "[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]"


def _words_sql() -> str:
    out = "text"
    for old, new in (("THE", "DAS"), ("T[hH][eE]", "Das"), ("t[hH][eE]", "das")):
        for _ in range(2):  # neighbours share the letter between them
            out = f"regexp_replace({out}, '(^|{_W.replace('[', '[^', 1)}){old}({_W.replace('[', '[^', 1)}|$)', '\\1{new}\\2', 'g')"
    return f"SELECT doc_id, {out} AS edited, times > 0 AS changed, times FROM (SELECT *, len(list_filter(regexp_extract_all(text, '{_W}+'), lambda x: lower(x) = 'the'))::BIGINT AS times FROM documents)"


def json_edit(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.from_json("props", "k long, extra string").alias("p"))
    edited = e.withColumn("p", F.col("p").withField("text", F.concat(F.lit("n"), F.col("p.k").cast("string"))).dropFields("extra"))
    return edited.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("payload"))


JSON_SQL = """SELECT event_id, (props->>'$.k')::BIGINT AS k, '{"k":' || (props->>'$.k') || ',"text":"n' || (props->>'$.k') || '"}' AS payload FROM events"""


def score_vector_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    per = e.groupBy("user_id", "event_type").agg((F.count("*") * 0.25).alias("score"))
    text = per.groupBy("user_id").agg(T.vector_text(F.transform(F.array_sort(F.collect_list(F.struct("event_type", "score"))), lambda s: F.struct(s["event_type"].alias("name"), s["score"].alias("score")))).alias("vector"))
    return text.select("user_id", "vector", F.round(F.aggregate(F.map_values(T.vector_map("vector")), F.lit(0.0), lambda a, v: a + v), 6).alias("total"), F.size(T.vector_map("vector")).cast("long").alias("parts"))


VECTOR_SQL = """
WITH p AS (SELECT user_id, event_type, count(*) * 0.25::DOUBLE AS score FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type || ':' || printf('%.2f', score), '|' ORDER BY event_type) AS vector, round(sum(score), 6) AS total, count(*) AS parts FROM p GROUP BY user_id"""


def findings_explode(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    one = lambda c, category, priority: F.when(c, F.struct(F.lit(category).alias("category"), F.lit(priority).alias("priority")))
    found = F.array_compact(F.array(one(t.contains("*"), "marcacao", "alta"), one(T.inner_punctuation(t) > 40, "pontuacao", "media"), one(t.rlike("[0-9]{3,}"), "numeros", "baixa")))
    return _docs(spark, d).select("doc_id", F.posexplode(found).alias("seq", "f")).select("doc_id", F.col("seq").cast("long").alias("seq"), "f.category", "f.priority")


FINDINGS_SQL = """
WITH t AS (SELECT doc_id, contains(text, '*') AS a, len(regexp_extract_all(regexp_replace(text, '[.!?…\\s]+$', ''), '\\.\\.\\.|[,;:—–-]')) > 40 AS b, regexp_matches(text, '[0-9]{3,}') AS c FROM documents)
SELECT doc_id, 0::BIGINT AS seq, 'marcacao' AS category, 'alta' AS priority FROM t WHERE a
UNION ALL SELECT doc_id, a::BIGINT, 'pontuacao', 'media' FROM t WHERE b
UNION ALL SELECT doc_id, a::BIGINT + b::BIGINT, 'numeros', 'baixa' FROM t WHERE c"""


def propernoun_stats(spark: SparkSession, d: str) -> DataFrame:
    token = _docs(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z'-]*"), 0)).alias("t"))
    return token.groupBy(F.lower("t").alias("token")).agg(
        F.count("*").alias("total"), F.count_if(F.col("t").rlike("^[A-Z]")).alias("capital"), F.count_distinct("doc_id").alias("lines"), F.round(F.count_if(F.col("t").rlike("^[A-Z]")) / F.count("*"), 4).alias("ratio")
    ).where("total >= 5")


NOUNS_SQL = """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z''-]*')) AS t FROM documents)
SELECT lower(t) AS token, count(*) AS total, count(*) FILTER (WHERE regexp_matches(t, '^[A-Z]')) AS capital, count(DISTINCT doc_id) AS lines,
  round(count(*) FILTER (WHERE regexp_matches(t, '^[A-Z]')) / count(*)::DOUBLE, 4) AS ratio FROM t GROUP BY 1 HAVING count(*) >= 5"""


def line_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    lines = docs.select(F.col("doc_id").alias("ident"), "text", F.col("doc_id").alias("line_no"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    corrections = labels.where("quality = 0").select(F.col("doc_id").alias("ident"), F.lit("usar_original").alias("action"), F.lit("").alias("text"), F.lit("baixa qualidade").alias("reason"))
    durations = docs.where("lang <> 'de'").select(F.col("doc_id").alias("ident"), (F.col("n_chars") / 15.0).alias("duration"))
    out = prepare.manifest(lines, corrections.join(lines.select("ident"), "ident", "left_semi"), durations, strict=False)
    return out.select("ident", "action", "final_text", "review", "detail", F.round("duration", 6).alias("duration"))


def _manifest_sql() -> str:
    known = ", ".join(f"'{x}'" for x in T.NONVERBAL)
    unmarked = CLEAN_SQL[CLEAN_SQL.index("regexp_replace(trim("):CLEAN_SQL.index(" AS unmarked")]
    edge = _W.replace("[", "[^", 1)
    found = lambda p: f"regexp_matches(clean, '(?i)(^|{edge})' || '{p.replace(chr(92) + 'b', '')}' || '($|{edge})')"
    return f"""
WITH t AS (SELECT doc_id AS ident, {unmarked} AS clean, CASE WHEN lang <> 'de' THEN n_chars / 15 END AS duration, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS fixed,
  list_filter(list_transform(regexp_extract_all(text, '\\*+([^*]+?)\\*+', 1), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: lower(x) NOT IN ({known})) AS unknown FROM documents),
u AS (SELECT *, regexp_matches(clean, '^[\\s.…,;:!?—–-]*$') AS empty FROM t)
SELECT ident, CASE WHEN fixed OR empty THEN 'usar_original' ELSE 'gerar' END AS action, CASE WHEN fixed OR empty THEN '' ELSE clean END AS final_text,
  concat_ws(',', CASE WHEN len(unknown) > 0 AND NOT fixed THEN 'revisar_marcacao' END, CASE WHEN NOT fixed AND NOT empty AND {found(prepare.FIRST_PERSON)} AND {found(prepare.MASCULINE)} THEN 'revisar_genero' END,
    CASE WHEN duration IS NULL THEN 'duracao_ausente' END) AS review,
  concat_ws(' | ', CASE WHEN fixed THEN 'baixa qualidade' END, CASE WHEN NOT fixed AND empty THEN 'sem conteúdo lexical' END, CASE WHEN len(unknown) > 0 THEN 'marcação mantida: ' || array_to_string(unknown, ', ') END) AS detail, round(duration, 6) AS duration
FROM u"""


QUERIES = {
    "style_cascade_counts": style_cascade_counts, "hex_id_text_metrics": hex_id_text_metrics, "normalized_ids": normalized_ids, "text_markers": text_markers, "normalize_text": normalize_text,
    "clean_markup_spacing": clean_markup_spacing, "style_scored_argmax": style_scored_argmax, "style_catalog_pivot": style_catalog_pivot, "acoustic_refinement": acoustic_refinement,
    "text_edits": text_edits, "word_replacement": word_replacement, "json_edit": json_edit, "score_vector_roundtrip": score_vector_roundtrip, "findings_explode": findings_explode,
    "propernoun_stats": propernoun_stats, "line_manifest": line_manifest,
}
ORACLE_SQL = {
    "style_cascade_counts": _cascade_sql(), "hex_id_text_metrics": HEX_SQL, "normalized_ids": IDS_SQL, "text_markers": MARKERS_SQL, "normalize_text": NORMALIZE_SQL, "clean_markup_spacing": CLEAN_SQL,
    "style_scored_argmax": _scored_sql(), "style_catalog_pivot": _pivot_sql(), "text_edits": EDITS_SQL, "json_edit": JSON_SQL, "score_vector_roundtrip": VECTOR_SQL, "findings_explode": FINDINGS_SQL,
    "propernoun_stats": NOUNS_SQL, "acoustic_refinement": _refined_sql(), "word_replacement": _words_sql(), "line_manifest": _manifest_sql(),
}
