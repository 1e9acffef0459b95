"""Lines to manifest and payload; audits to review queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import portuguese as P
from ..functions import text as T
from ..operators import integrity, relational

# Cues of a first person and of masculine agreement.
FIRST_PERSON = r"\b(?:eu|sou|estou|fui|era|fico|fiquei|continuo|me sinto|obrigado)\b"
MASCULINE = (
    r"\b(?:obrigado|cansado|preocupado|pronto|sozinho|machucado|ferido|assustado|aliviado|certo|errado|convencido|surpreso|perdido|"
    r"amaldiçoado|encantado|satisfeito|orgulhoso|ocupado)\b"
)
ONLY_MARKS = r"^[\s.…,;:!?—–-]*$"


def line_plan(text: Column, correction: Column, duration: Column) -> Column:
    """(action, final_text, review, detail) of a line.

    A correction (struct of action, text, reason; null without one) goes first, then a text that
    has nothing left to say is kept as recorded, then the cleaned text is generated. Review flags
    what was unmarked, what may need another gender, and a missing duration.
    """
    clean = T.clean_markup(text)
    unknown = T.markup_tokens(text, known=False)
    empty = clean.rlike(ONLY_MARKS)
    fixed = correction["action"].isNotNull()
    action = F.when(fixed, correction["action"]).when(empty, "usar_original").otherwise("gerar")
    final = F.when(fixed & (correction["action"] == "gerar"), T.first_text(correction["text"], clean)).when(action == "gerar", clean).otherwise("")
    suspect = P.gender_suspect(clean, (FIRST_PERSON, MASCULINE)) & (action == "gerar") & ~fixed
    review = F.array_join(F.array_compact(F.array(F.when((F.size(unknown) > 0) & ~fixed, "revisar_marcacao"), F.when(suspect, "revisar_genero"), F.when(duration.isNull(), "duracao_ausente"))), ",")
    detail = T.reasons([(fixed, F.coalesce(correction["reason"], F.lit(""))), (~fixed & empty, "sem conteúdo lexical"), (F.size(unknown) > 0, F.concat(F.lit("marcação mantida: "), F.array_join(unknown, ", ")))])
    return F.struct(action.alias("action"), final.alias("final_text"), review.alias("review"), detail.alias("detail"))


def manifest(lines: DataFrame, corrections: DataFrame, durations: DataFrame, strict: bool = True) -> DataFrame:
    """(ident, text, lines, action, final_text, review, detail, duration) of all lines.

    lines: ident, text, line_no; corrections: ident, action, text, reason; durations: ident,
    duration. If strict, conflicting texts and corrections of unknown lines raise.
    """
    merged = integrity.dedup_with_provenance(lines, "ident", "text", "line_no")
    if strict:
        integrity.require_none(merged.where("conflict"), "texts differ")
        integrity.require_none(integrity.duplicates(corrections, "ident"), "repeated corrections")
        integrity.require_none(relational.missing(corrections, lines, "ident"), "corrections of unknown lines")
    fix = corrections.select("ident", F.struct("action", "text", "reason").alias("correction"))
    joined = merged.join(fix, "ident", "left").join(durations.select("ident", "duration"), "ident", "left")
    planned = joined.withColumn("plan", line_plan(F.col("text"), F.col("correction"), F.col("duration")))
    return planned.select("ident", "text", "lines", "plan.*", "duration")


def payload(plan: DataFrame, references: DataFrame, default: str, with_duration: bool = False) -> DataFrame:
    """What a generator gets: id, text, reference of the line's style (the default's where unknown)."""
    rows = plan.where("action = 'gerar'").withColumn("style", F.coalesce("style", F.lit(default)) if "style" in plan.columns else F.lit(default))
    out = rows.join(references.where("enabled"), "style", "left")
    return out.select(T.hex_id("ident").alias("id"), F.col("final_text").alias("text"), "ref_audio", *(["duration"] if with_duration else []))


# Masculine articles before feminine words, and what findings are called and say.
SUSPICIOUS = r"\b(?:um|o|esse|seu|nenhum)\s+(?:bruxa|amiga|bandida|assassina|inimiga|aluna|forasteira|convidada|criada|prisioneira|soldada)\b"
NOTHING_SPOKEN = "; fala sem conteúdo verbal restante"
CONFIRMED = " (contexto confirmado por ID)"


def _markers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(P.STAR), F.lit(1)), T.strip)


def audit_findings(lines: DataFrame, edits: DataFrame | None = None, reviews: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """(ident, seq, category, priority, action, before, after, note): 0 to 5 findings of each line.

    lines: ident, action, original, text; edits: ident, seq, old, new; reviews: ident, old, new,
    note. Order of emission: a marker that was treated before (informativa); then, for lines to be
    generated, sounds (alta; usar_original if no word is left); gender, on the cleaned text: the
    line's own edits, then words after first-person cues (alta); the line's review (media); a
    masculine article before a feminine word (media). The last two look at the text as it is. If
    strict, edits and reviews whose fragment isn't in the line's text raise.
    """
    spark = lines.sparkSession
    none = spark.createDataFrame([], "ident long, seq int, old string, new string, note string").withColumn("ident", F.lit(None).cast(lines.schema["ident"].dataType))
    edits = none.select("ident", "seq", "old", "new") if edits is None else edits
    reviews = none.select("ident", "old", "new", "note") if reviews is None else reviews
    w = lines.select("ident", (F.lower(T.strip(F.coalesce("action", F.lit("")))) == "gerar").alias("on"), T.strip(F.coalesce("original", F.lit(""))).alias("original"), T.strip(F.coalesce("text", F.lit(""))).alias("text"))
    w = w.withColumn("v", P.without_sounds(F.col("text"))).withColumn("base", F.when(F.size("v.notes") > 0, F.col("v.text")).otherwise(F.col("text")))
    w = P.apply_rules(w, edits, "ident", "base", "own").withColumnRenamed("notes", "own_notes").withColumn("g", P.feminine(F.col("own")))
    w = w.join(reviews.select("ident", F.struct("old", "new", "note").alias("r")), "ident", "left")
    if strict:
        integrity.require_none(w.where("on and absent is not null").select("ident", "absent"), "fragment of an edit is missing")
        integrity.require_none(w.where("on and r is not null").where(~F.contains("text", F.col("r.old"))).select("ident", "r.old"), "fragment of a review is missing")
    on, silent = F.col("on"), ~F.col("v.text").rlike(T.LETTER + "{2,}")
    gender = F.concat(F.transform("own_notes", lambda n: F.concat(n, F.lit(CONFIRMED))), F.col("g.notes"))
    one = lambda seq, condition, category, priority, action, before, after, note: F.when(condition, F.struct(
        F.lit(seq).alias("seq"), F.lit(category).alias("category"), F.lit(priority).alias("priority"), action.alias("action"), before.alias("before"), after.alias("after"), note.alias("note")))
    found = F.array(
        one(0, (F.size(_markers(F.col("original"))) > 0) & (F.size(_markers(F.col("text"))) == 0), "marcacao_ja_tratada", "informativa", F.lit("nenhuma"), F.col("original"), F.col("text"),
            F.concat(F.lit("marcação removida na preparação: "), F.array_join(_markers(F.col("original")), ", "))),
        one(1, on & (F.size("v.notes") > 0), "vocalizacao_ou_acao", "alta", F.when(silent, "usar_original").otherwise("gerar"), F.col("text"), F.when(silent, "").otherwise(F.col("v.text")),
            F.concat(F.array_join("v.notes", "; "), F.when(silent, NOTHING_SPOKEN).otherwise(""))),
        one(2, on & (F.size(gender) > 0), "concordancia_feminina", "alta", F.lit("gerar"), F.col("base"), F.col("g.text"), F.array_join(gender, "; ")),
        one(3, on & F.col("r").isNotNull(), "concordancia_contextual", "media", F.lit("revisar"), F.col("text"), F.replace("text", F.col("r.old"), F.col("r.new")), F.col("r.note")),
        one(4, on & F.col("text").rlike("(?iuU)" + SUSPICIOUS), "concordancia_suspeita", "media", F.lit("revisar"), F.col("text"), F.lit(""), F.lit("artigo ou possessivo masculino antes de termo feminino")),
    )
    return w.select("ident", F.explode(F.array_compact(found)).alias("f")).select("ident", "f.*")


# Reasons and names of gender decisions.
CHANGED, APPROVED = "Concordância feminina da personagem jogável: ", "Aprovado sem alteração: termo não se refere à personagem jogável."


def gender_decisions(lines: DataFrame, rules: DataFrame, reasons: DataFrame, absent: DataFrame) -> DataFrame:
    """(ident, classification, action, original, final, reason, flag) of lines that are flagged, have rules, or are absent.

    lines: ident, text, flag; rules: ident, seq, kind, old, new (functions.portuguese.apply_rules);
    reasons: ident, reason, in place of the usual one; absent: ident, reason, of lines that keep
    their recording. A rule for an unknown line, and a fragment that isn't there, raise.
    """
    integrity.require_none(relational.missing(rules.select("ident").union(absent.select("ident")).distinct(), lines, "ident"), "decisions on unknown lines")
    known = rules.select("ident").distinct().withColumn("ruled", F.lit(True))
    chosen = lines.join(known, "ident", "left").join(absent.select("ident", F.col("reason").alias("gone")), "ident", "left").where("coalesce(flag, '') <> '' or ruled or gone is not null")
    edited = P.apply_rules(chosen, rules, "ident", "text", "final")
    integrity.require_none(edited.where("absent is not null and gone is null").select("ident", "absent"), "fragment of a rule is missing")
    edited = edited.join(reasons.select("ident", F.col("reason").alias("own")), "ident", "left")
    gone, changed = F.col("gone").isNotNull(), F.col("final") != F.col("text")
    reason = F.when(gone, F.col("gone")).when(F.col("own").isNotNull(), F.col("own")).when(changed, F.concat(F.lit(CHANGED), F.array_join("notes", "; "), F.lit("."))).otherwise(APPROVED)
    return edited.select(
        "ident", F.when(gone, "usar_original").when(changed, "corrigido").otherwise("aprovado_sem_alteracao").alias("classification"), F.when(gone, "usar_original").otherwise("gerar").alias("action"),
        F.col("text").alias("original"), F.when(gone, "").otherwise(F.col("final")).alias("final"), reason.alias("reason"), "flag",
    )


def safe_fixes(findings: DataFrame, legacy_order: bool = False) -> DataFrame:
    """(ident, action, text, reason): the last automatic fix of each line, reasons joined.

    Fixes follow one another in order of emission; with legacy_order by category name, which drops
    the gender edit of a line that has both kinds.
    """
    order = F.struct("category", "seq") if legacy_order else F.struct("seq", "category")
    fixes = findings.where("action in ('gerar', 'usar_original')").groupBy("ident").agg(F.array_sort(F.collect_list(F.struct(order.alias("k"), "action", "after", "note"))).alias("s"))
    return fixes.select("ident", F.element_at("s", -1)["action"].alias("action"), F.element_at("s", -1)["after"].alias("text"), F.array_join(F.transform("s", lambda x: x["note"]), " | ").alias("reason"))


def name_statistics(lines: DataFrame, ident: str, text: str, least_ratio: float = 0.68, least_single: float = 0.78, examples: int = 5) -> DataFrame:
    """(name, lines, ratio, inside, examples) of accepted proper names.

    Names come from runs of capitalised words. Of a name's words but connectors, ratio is the
    lowest share in which one is capitalised wherever it occurs, and inside tells whether one is so
    within a sentence. A name needs the least ratio (least_single if it is one word), no stop-word,
    and evidence inside or two lines. examples are the smallest idents, in order.
    """
    token = lines.select(F.explode(P.tokens(F.col(text))).alias("x")).select(F.lower(T.normalize_term(F.col("x.token"))).alias("part"), F.col("x.token").rlike(f"^{P.CAPITAL}").alias("capital"), (~F.col("x.opens")).alias("within"))
    shares = token.groupBy("part").agg((F.count_if("capital") / F.count("*")).alias("share"), F.max(F.col("capital") & F.col("within")).alias("within"))
    chunks = lines.select(F.col(ident).alias("i"), F.explode(F.array_distinct(F.transform(P.name_chunks(F.col(text)), lambda c: c["name"]))).alias("name"))
    counts = chunks.groupBy("name").agg(F.count("*").alias("lines"))
    # each task keeps its few smallest, so a frequent name's lines are never in one place
    few = chunks.groupBy("name", F.pmod(F.xxhash64("i"), F.lit(64)).alias("bin")).agg(F.slice(F.array_sort(F.collect_set("i")), 1, examples).alias("some"))
    few = few.groupBy("name").agg(F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, examples).alias("examples"))
    parts = counts.select("name", F.explode(F.filter(F.split(F.lower("name"), " "), lambda p: ~p.isin(*sorted(P.CONNECTORS)))).alias("part"))
    judged = parts.join(shares, "part").groupBy("name").agg(F.min("share").alias("ratio"), F.max("within").alias("inside"), F.count("*").alias("parts"), F.max(F.col("part").isin(*sorted(P.STOPWORDS))).alias("common"))
    out = counts.join(judged, "name").join(few, "name").where(~F.col("common") & (F.col("ratio") >= F.when(F.col("parts") == 1, least_single).otherwise(least_ratio)) & (F.col("inside") | (F.col("lines") >= 2)))
    return out.select("name", "lines", F.round("ratio", 4).alias("ratio"), "inside", "examples")
