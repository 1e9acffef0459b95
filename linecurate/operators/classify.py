"""Delivery styles of lines: a first-match cascade, a weighted lexicon, and their refinement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .lexicon import fragment_scores

# Catalogue order decides ties.
STYLES = (
    "conversa_neutra", "investigacao_observacional", "pergunta_cautelosa", "confronto_firme", "ironia_seca",
    "narrativa_contida", "alerta_tenso", "combate_agressivo", "tristeza_contida",
)

# Fragments of the cascade.
CASCADE = {
    "ironia_seca": ("astucia", "digno de um cavaleiro", "interacao mais intima", "bruxos digo nos"),
    "confronto_firme": ("acordo com", "nilfgaard"),
    "investigacao_observacional": ("pegada", "monstro", "anotac", "trancad", "outro caminho", "fezes de insetos", "caverna", "assassinato", "teoria", "raciocinio"),
}

# Weighted fragments; * matches any ending.
LEXICON: dict[str, tuple[tuple[str, float], ...]] = {
    "investigacao_observacional": (
        ("pegada*", 3.5), ("rastro*", 3.5), ("vestigio*", 3.0), ("pista*", 3.0), ("sangue", 2.0), ("cheiro*", 2.0), ("cadaver*", 2.5), ("corpo*", 1.2),
        ("ferida*", 1.5), ("mordida*", 2.0), ("garra*", 2.0), ("marca*", 1.0), ("monstro*", 1.8), ("criatura*", 1.5), ("ninho*", 2.0), ("caverna*", 1.6),
        ("trancad*", 2.0), ("fechadura*", 2.0), ("outro caminho", 2.0), ("anotac*", 2.0), ("ritual*", 1.5), ("veneno*", 1.5), ("fresco*", 1.0),
        ("examin*", 2.5), ("investig*", 2.5), ("raciocinio*", 1.5), ("teoria*", 1.2),
    ),
    "combate_agressivo": (
        ("ataque", 2.5), ("ataquem", 3.5), ("mate", 3.5), ("matem", 3.5), ("vou te matar", 5.0), ("vou mata*", 4.0), ("morra", 4.5), ("acabe com", 3.0),
        ("nao vai escapar", 3.5), ("nao escapara", 3.5), ("prepare se", 2.5), ("saque a espada", 3.0), ("largue a espada", 2.5), ("lutar", 1.0), ("luta", 0.8),
        ("batalha*", 0.8), ("combate*", 1.0), ("espada*", 0.5), ("fique atras de mim", 3.0), ("cubram", 2.5), ("cercad*", 1.5), ("emboscada*", 1.0), ("inimigo*", 1.2),
    ),
    "tristeza_contida": (
        ("sinto muito", 4.5), ("me desculpe", 4.0), ("perdao", 3.5), ("sinto falta", 5.0), ("saudades", 4.0), ("nao pude salvar", 5.0), ("nao consegui salvar", 5.0),
        ("foi minha culpa", 5.0), ("e minha culpa", 5.0), ("nunca vou esquecer", 4.0), ("descanse em paz", 4.5), ("va em paz", 3.5), ("adeus", 3.0), ("perdi ", 3.0),
        ("eu falhei", 4.0), ("morreu", 1.0), ("morto*", 0.8), ("morta*", 0.8), ("dor", 0.8), ("sofr*", 1.0), ("chor*", 1.2), ("lamento", 2.0), ("triste*", 2.0),
    ),
    "ironia_seca": (
        ("que surpresa", 3.5), ("muito engracado", 3.5), ("gracinha", 3.0), ("piada*", 1.0), ("brincando", 1.2), ("astucia", 3.0), ("digno de", 2.0), ("claro que", 0.8),
        ("imagino", 1.3), ("suponho", 1.3), ("e mesmo", 1.5), ("por acaso", 1.2), ("digo nos", 2.5), ("interacao mais intima", 3.0), ("maravilha", 1.2), ("otimo", 0.8),
    ),
    "confronto_firme": (
        ("como ousa", 4.0), ("voce mentiu", 4.0), ("esta mentindo", 3.5), ("diga a verdade", 4.0), ("nao acredito em voce", 3.5), ("responda", 2.5), ("confesse", 3.5),
        ("explique", 2.0), ("por que voce", 2.2), ("o que voce fez", 2.5), ("acordo com", 1.0), ("nilfgaard", 0.5), ("afaste se", 2.5), ("pare agora", 3.0),
        ("nao vou permitir", 3.0), ("nao permitirei", 3.0),
    ),
    "alerta_tenso": (
        ("cuidado", 4.0), ("fique alerta", 4.0), ("atencao", 3.0), ("algo esta", 1.2), ("ouviu isso", 2.5), ("o que foi isso", 2.5), ("ali ", 1.2), ("depressa", 2.0),
        ("rapido", 1.5), ("estamos cercad*", 3.5), ("esta perto", 2.0),
    ),
}


def cascade(text: Column, markers: Column, duration: Column, fragments: Mapping[str, Sequence[str]] = CASCADE) -> Column:
    """(style, confidence) of the first rule that holds; markers come from their own column.

    Irony, confrontation, long narration, investigation, alert, question, neutral. Fragments are
    looked for anywhere in the folded text, also inside words.
    """
    return T.given(F.struct(T.fold(text).alias("folded"), F.regexp_count(text, F.lit(r"(?U)\w+")).alias("count")), lambda x: _cascade(x["folded"], x["count"], markers, duration, fragments))


def _cascade(folded: Column, count: Column, markers: Column, duration: Column, fragments: Mapping[str, Sequence[str]]) -> Column:
    holds = lambda style: F.exists(F.array(*[F.lit(f) for f in fragments[style]]), lambda f: F.contains(folded, f)) if fragments[style] else F.lit(False)
    has = lambda mark: F.array_contains(F.split(markers, "[|]"), mark)
    ask = has("pergunta")
    rules = (
        (holds("ironia_seca"), "ironia_seca", "alta"),
        (holds("confronto_firme"), "confronto_firme", "alta"),
        ((count >= 25) | (duration >= 8), "narrativa_contida", "alta"),
        (holds("investigacao_observacional"), "investigacao_observacional", "alta"),
        (has("exclamacao") | ask & (count <= 3) | ask & has("reticencias") & (count <= 6), "alerta_tenso", "media"),
        (ask, "pergunta_cautelosa", "media"),
    )
    out = None
    for condition, style, confidence in rules:
        value = F.struct(F.lit(style).alias("style"), F.lit(confidence).alias("confidence"))
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.struct(F.lit("conversa_neutra").alias("style"), F.lit("media").alias("confidence")))


def with_style_scores(lines: DataFrame, key: str, text: str, duration: Column, lexicon: DataFrame) -> DataFrame:
    """lines with `scores`: an array of (name, score) structs in catalogue order; a duration of 0 means it is missing.

    key is unique. The lexicon is a table as lexicon.table makes it, of any length.
    """
    folded = lines.withColumn("__folded", T.fold(F.col(text)))
    hits = fragment_scores(folded, key, "__folded", lexicon)
    joined = folded.join(hits, key, "left")
    scores = T.given(F.struct(F.col("__folded").alias("folded"), T.alnum_words(F.col(text)).alias("count"), F.map_from_entries(F.coalesce("hits", F.array().cast("array<struct<style:string,score:double>>"))).alias("base")), lambda x: _style_scores(
        F.col(text), x["folded"], x["count"], duration, x["base"]))
    return joined.withColumn("scores", scores).drop("__folded", "hits")


def _style_scores(text: Column, folded: Column, count: Column, duration: Column, found: Column) -> Column:
    ask, cry, dots = text.contains("?"), text.contains("!"), text.rlike(r"\.\.\.|…")
    parts = F.greatest(F.lit(1), F.regexp_count(text, F.lit("[.!?]+")))
    given = lambda condition, points: F.when(condition, points).otherwise(0.0)
    base = {s: F.coalesce(F.try_element_at(found, F.lit(s)), F.lit(0.0)) for s in STYLES}
    sad = F.when(folded.contains("me sinto muito"), F.greatest(F.lit(0.0), base["tristeza_contida"] - 4.5)).otherwise(base["tristeza_contida"])
    firm = F.when(folded.contains("de acordo com"), F.greatest(F.lit(0.0), base["confronto_firme"] - 1.0)).otherwise(base["confronto_firme"])
    clues = base["investigacao_observacional"]
    alert = (
        base["alerta_tenso"] + F.when(ask & (count <= 4), 2.0).when(ask & dots & (count <= 8), 1.5).otherwise(0.0) + given(cry, 1.5)
        + given((duration > 0) & (count / F.nullif(duration, F.lit(0.0)) >= 8.5), 0.8) + given((count <= 3) & (duration <= 1.5) & ~ask, 0.8)
    )
    scores = {
        "conversa_neutra": 1.0 + given((count >= 4) & (count <= 22) & ~cry, 0.5),
        "investigacao_observacional": clues,
        "pergunta_cautelosa": base["pergunta_cautelosa"] + given(ask, 2.4),
        "confronto_firme": firm + given(ask & (firm >= 2.0), 0.8),
        "ironia_seca": base["ironia_seca"] + given(dots, 0.4),
        "narrativa_contida": base["narrativa_contida"] + given(count >= 25, 3 + F.least(F.lit(2.0), (count - 25) / 18.0))
        + given(duration >= 8, 2.5 + F.least(F.lit(1.5), (duration - 8) / 8.0)) + given((parts >= 3) & (count >= 18), 1.2),
        "alerta_tenso": alert,
        "combate_agressivo": base["combate_agressivo"] + given(cry, 0.8),
        "tristeza_contida": F.when((sad <= 1.2) & (clues >= 2.5), sad * 0.35).otherwise(sad),
    }
    return F.array(*[F.struct(F.lit(s).alias("name"), scores[s].cast("double").alias("score")) for s in STYLES])


def decide(scores: Column, pilot: Column | None = None, neutral: str = "conversa_neutra") -> Column:
    """(style, second, top, margin, confidence, review, priority, origin) of a score vector in catalogue order.

    The best style but neutral wins (ties: catalogue order) if it reaches 2, else neutral. The
    second is the best of all others. A specific style is to be reviewed with priority alta if its
    margin is under 0.35, media if its confidence is low; neutral with priority baixa if a specific
    style came to 1.9 or more; else nenhuma. A line's style in pilot (null: none) overrides all that.
    """
    ranked = lambda xs: F.array_sort(F.transform(xs, lambda x, i: F.struct((-x["score"]).alias("k"), i.alias("i"), x["name"].alias("name"))))

    def chosen(x: Column) -> Column:
        # positions after filtering keep catalogue order
        lead = F.get(ranked(F.filter(x["scores"], lambda s: s["name"] != neutral)), F.lit(0))
        own = F.get(F.filter(x["scores"], lambda s: s["name"] == neutral), F.lit(0))["score"]
        return F.struct(x["scores"].alias("scores"), x["pilot"].alias("pilot"), (-lead["k"]).alias("points"), lead["name"].alias("lead"), own.alias("own"))

    def compared(x: Column) -> Column:
        plain = x["points"] < 2.0
        style = F.coalesce(x["pilot"], F.when(plain, F.lit(neutral)).otherwise(x["lead"]))
        top = F.when(plain, x["own"]).otherwise(x["points"])
        return T.given(F.struct(x["scores"].alias("scores"), style.alias("style"), top.alias("top"), plain.alias("plain"), x["points"].alias("points"), x["pilot"].alias("pilot")), lambda y: F.struct(
            y["style"].alias("style"), y["top"].alias("top"), y["plain"].alias("plain"), y["points"].alias("points"), y["pilot"].alias("pilot"),
            F.get(ranked(F.filter(y["scores"], lambda s: s["name"] != y["style"])), F.lit(0)).alias("second")))

    def judged(x: Column) -> Column:
        margin = x["top"] + x["second"]["k"]
        confidence = (
            F.when(x["plain"], F.when(x["points"] < 1.5, "media").otherwise("baixa"))
            .when((x["top"] >= 5) & (margin >= 2), "alta").when((x["top"] >= 2.3) & (margin >= 0.70), "media").otherwise("baixa")
        )
        priority = (
            F.when(~x["plain"] & (margin < 0.35), "alta").when(~x["plain"] & (confidence == "baixa"), "media")
            .when(x["plain"] & (x["points"] >= 1.9), "baixa").otherwise("nenhuma")
        )
        known = x["pilot"].isNotNull()
        unless = lambda value, other: F.when(known, other).otherwise(value)
        return F.struct(
            x["style"].alias("style"), x["second"]["name"].alias("second"), unless(x["top"], 99.0).alias("top"), unless(margin, 99.0).alias("margin"), unless(confidence, "alta").alias("confidence"),
            unless(F.when(priority == "nenhuma", "não").otherwise("sim"), "não").alias("review"), unless(priority, "nenhuma").alias("priority"),
            unless(F.lit("regras_semanticas_duracao"), "piloto_confirmado").alias("origin"),
        )

    start = F.struct(scores.alias("scores"), (F.lit(None).cast("string") if pilot is None else pilot).alias("pilot"))
    return T.given(start, lambda x: T.given(chosen(x), lambda y: T.given(compared(y), judged)))


def candidate_quality(style: Column, score: Column, margin: Column, duration: Column, count: Column) -> Column:
    """How good a line is as a sample of its style; from stored (rounded) score and margin."""
    target = F.when(style == "narrativa_contida", 9.0).otherwise(4.0)
    return score + margin + F.greatest(F.lit(0.0), 3 - F.abs(duration - target) * 0.45) + F.when(count.between(5, 22), 1.5).otherwise(0.0)


def sample_eligible(style: Column, duration: Column, count: Column) -> Column:
    return (duration >= 1.2) & (duration <= F.when(style == "narrativa_contida", 14.0).otherwise(7.5)) & (count >= 4)


# Acoustic points, (intensity alta, media, baixa), (pace rapido, normal, lento), pauses.
ACOUSTIC: dict[str, tuple[tuple[float, float, float], tuple[float, float, float], dict[str, float]]] = {
    "alerta_tenso": ((1.5, 0.5, -0.8), (1.2, 0.2, -0.6), {"sem_pausa": 0.5}),
    "combate_agressivo": ((1.5, 0.5, -0.8), (1.2, 0.2, -0.6), {"sem_pausa": 0.5}),
    "confronto_firme": ((1.0, 0.5, -0.2), (0.7, 0.3, 0.0), {}),
    "investigacao_observacional": ((0.2, 0.6, 0.8), (0.0, 0.6, 0.8), {"pausa_frequente": 1.0, "pausa_leve": 0.4}),
    "tristeza_contida": ((-0.8, 0.5, 1.4), (-0.7, 0.4, 1.0), {"pausa_frequente": 0.8, "pausa_leve": 0.2}),
    "ironia_seca": ((0.0, 0.3, 0.3), (0.0, 0.6, 0.8), {"pausa_frequente": 0.6, "pausa_leve": 0.6}),
    "pergunta_cautelosa": ((0.0, 0.7, 1.0), (0.0, 0.6, 0.8), {"pausa_frequente": 0.4, "pausa_leve": 0.4}),
    "narrativa_contida": ((0.0, 0.0, 0.0), (0.0, 0.7, 0.6), {"pausa_frequente": 0.6, "pausa_leve": 0.2}),
    "conversa_neutra": ((0.1, 0.4, 0.1), (0.2, 0.5, 0.2), {}),
}


def acoustic_support(style: Column, intensity: Column, pace: Column, pauses: Column, duration: Column) -> Column:
    """Points that the sound of a line gives a style."""
    table = []
    for name, (by_intensity, by_pace, by_pause) in ACOUSTIC.items():
        points = F.lit(0.0)
        for column, names, values in ((intensity, ("alta", "media", "baixa"), by_intensity), (pace, ("rapido", "normal", "lento"), by_pace), (pauses, tuple(by_pause), tuple(by_pause.values()))):
            for n, v in zip(names, values):
                points = points + F.when(column == n, v).otherwise(0.0)
        if name == "narrativa_contida":
            points = points + F.when(duration == "longa", 1.3).otherwise(0.0)
        table.append((name, points))
    out = F.when(style == table[0][0], table[0][1])
    for name, points in table[1:]:
        out = out.when(style == name, points)
    return F.coalesce(out, F.lit(0.0))


def refine(df: DataFrame) -> DataFrame:
    """Settles lines whose two best styles are close, by their sound.

    df has style, second, top, second_score, has_cry, intensity, pace, pauses, duration_band. Adds
    style_refined, confidence_refined, review_refined. Alert against question is decided by cries
    and tension; question against another style by that style's score; any other pair by scores
    with acoustic points, where the second wins by more than 0.6 only.
    """
    a, b = F.col("style"), F.col("second")
    tense = (F.col("intensity") == "alta") & ((F.col("pace") == "rapido") | (F.col("pauses") == "sem_pausa"))
    pair = lambda x, y: ((a == x) & (b == y)) | ((a == y) & (b == x))
    asked = (a == "pergunta_cautelosa") | (b == "pergunta_cautelosa")
    other = F.when(a == "pergunta_cautelosa", b).otherwise(a)
    score = F.when(a == "pergunta_cautelosa", F.col("second_score")).otherwise(F.col("top"))
    loud, quick = F.col("intensity") == "alta", F.col("pace") == "rapido"
    keeps = (
        (other.isin("investigacao_observacional", "ironia_seca", "narrativa_contida") & (score >= 2.4))
        | ((other == "confronto_firme") & ((score >= 3.2) | loud | quick))
        | ((other == "tristeza_contida") & (score >= 3.5))
        | ((other == "combate_agressivo") & (score >= 3.5) & (loud | quick))
    )
    support = lambda s: acoustic_support(s, F.col("intensity"), F.col("pace"), F.col("pauses"), F.col("duration_band"))
    first, other_score = F.col("top") + support(a), F.col("second_score") + support(b)
    lead, flips = first - other_score, other_score > first + 0.6
    style = (
        F.when(pair("alerta_tenso", "pergunta_cautelosa"), F.when(F.col("has_cry") | tense, "alerta_tenso").otherwise("pergunta_cautelosa"))
        .when(asked, F.when(keeps, other).otherwise(F.lit("pergunta_cautelosa"))).otherwise(F.when(flips, b).otherwise(a))
    )
    confidence = F.when(asked, "media").when(F.abs(lead) >= 0.45, "media").otherwise("baixa")
    out = df.withColumn("style_refined", style).withColumn("confidence_refined", confidence)
    unsettled = (F.col("confidence_refined") == "baixa") & (F.abs(F.col("top") - F.col("second_score")) < 0.2) & (F.col("style_refined") == a)
    return out.withColumn("review_refined", F.when(unsettled, "sim").otherwise("não"))
