"""Golden strings of the text functions."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from linecurate.functions import portuguese as P
from linecurate.functions import text as T
from linecurate.operators import classify, lexicon


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "clean"), [("*Suspira* Estou pronta.", "Estou pronta."), ("Que bom que *eu* o encontrei...", "Que bom que eu o encontrei..."), ("*Cof* *Cof* *Cof*", "")])
def test_clean_markup(spark, text, clean):
    assert one(spark, T.clean_markup("t"), t=text) == clean


def test_markup_tokens(spark):
    assert one(spark, T.markup_tokens("t", True), t="*Suspira* Que *eu* vi") == ["Suspira"]
    assert one(spark, T.markup_tokens("t", False), t="*Suspira* Que *eu* vi") == ["eu"]


SOUNDS = [
    ("*Suspira* Está bem. Vamos.", "Está bem. Vamos."), ("Argh. Vou começar de novo.", "Vou começar de novo."),
    ("Argh. Sonhei primeiro... depois, só pesadelos.", "Sonhei primeiro... depois, só pesadelos."), ("Aaa-argh! Agora corra.", "Agora corra."), ("Argh!", ""),
    ("Ugh. Cof! Tsc. Vamos.", "Vamos."), ("Jarro vazio. Cof. Agh, muito forte. Droga. Argh, tudo bem.", "Jarro vazio. Muito forte. Droga. Tudo bem."),
    ("Argh... maldito gato. Ffwsshht!", "Maldito gato."), ("Algo cheira estranho.", "Algo cheira estranho."), (None, ""),
]


SOUNDS += [
    ("Ah, argh, não.", "Ah, não."), ("{*Cof*} Oi *você* aí .", "Oi você aí."), ("Não, argh! Vem...", "Não, Vem..."), ("Vem -- argh, corre--já", "Vem... Corre... já"), ("... Tsc, sei.", "Sei."),
    ("Vai. AAARGH! urgh; ela veio. Cof!", "Vai. Ela veio."), ("Cargh e tscs ficam.", "Cargh e tscs ficam."),
]


def test_without_sounds(spark):
    rows = spark.createDataFrame(SOUNDS, "t string, want string").select("t", "want", P.without_sounds(F.col("t"))["text"].alias("got")).collect()
    assert [(r["t"], r["got"]) for r in rows] == SOUNDS


def test_without_sounds_notes(spark):
    notes = lambda t: one(spark, P.without_sounds(F.col("t")), t=t)["notes"]
    assert notes("Algo cheira estranho.") == []
    assert notes("*Suspira* Argh, *eu* vou. Cof.") == ["ação removida: Suspira", "marcação removida, texto preservado: eu", "vocalização escrita removida: Argh, Cof"]
    assert one(spark, P.without_sounds(F.col("t")), t="* * Oi")["text"] == "Oi"  # an empty marker counts as an action


@pytest.mark.parametrize(("text", "new"), [
    ("Estou pronto para partir.", "Estou pronta para partir."), ("Creio que estava certo em desconfiar.", "Creio que estava certa em desconfiar."),
    ("Você estava certo em desconfiar.", "Você estava certo em desconfiar."), ("O cheiro estava fraco.", "O cheiro estava fraco."), ("Sou um bruxo.", "Sou uma bruxa."), ("Estou PRONTO.", "Estou PRONTA."),
])
def test_feminine(spark, text, new):
    assert one(spark, P.feminine(F.col("t")), t=text)["text"] == new


def test_feminine_notes(spark):
    row = one(spark, P.feminine(F.col("t")), t="Eu mesmo sou o Ladrão, estou cansado e ando viajante.")
    assert row["text"] == "Eu mesma sou a Ladra, estou cansada e ando viajante."
    assert row["notes"] == ["mesmo→mesma em autorreferência explícita", "Ladrão→Ladra após gatilho de primeira pessoa", "cansado→cansada após gatilho de primeira pessoa"]


def test_rules_fold(spark):
    lines = spark.createDataFrame([(1, "Serei o mestre, a sumo"), (2, "nada")], "id int, text string")
    rules = spark.createDataFrame([(1, 1, "Serei o", "Serei a"), (1, 2, "Serei a mestre", "Serei a mestra"), (2, 1, "falta", "x")], "id int, seq int, old string, new string")
    out = {r["id"]: (r["edited"], r["absent"]) for r in P.apply_rules(lines, rules, "id", "text").collect()}
    assert out == {1: ("Serei a mestra, a sumo", None), 2: ("nada", "falta")}


def test_kinds_of_rules(spark):
    lines = spark.createDataFrame([(1, "Obrigado, Um bruxo. O BRUXO é obrigado."), (2, "nada")], "id int, text string")
    rules = spark.createDataFrame(
        [(1, 1, "obrigado", "obrigada", "word?"), (1, 2, "Um bruxo", "Uma bruxa", "literal?"), (1, 3, "bruxo", "bruxa", "word"), (1, 4, "é obrigada", "foi obrigada", None), (2, 1, "x", "y", "word?"), (2, 2, "z", "y", "word")],
        "id int, seq int, old string, new string, kind string",
    )
    out = {r["id"]: (r["edited"], r["absent"], r["notes"]) for r in P.apply_rules(lines, rules, "id", "text").collect()}
    assert out[1] == ("Obrigada, Uma bruxa. O BRUXA foi obrigada.", None, ["obrigado→obrigada", "Um bruxo→Uma bruxa", "bruxo→bruxa", "é obrigada→foi obrigada"])
    assert out[2] == ("nada", "z", [])


@pytest.mark.parametrize(("text", "names"), [
    ("Eu vi Ana de Castro e o Pedro.", ["Eu", "Ana de Castro", "Pedro"][1:]), ("Não. A Torre Negra caiu.", ["Torre Negra"]), (None, []), ("Vi Maria Da casa.", ["Vi Maria"]), ("Encontrei Ana, Bia.", ["Encontrei Ana Bia"]),
    ("Com Jan, van Eyck ali.", ["Com Jan van Eyck"]), ("O Dandelion canta.", []), ("E o Zé veio. Zé foi.", ["Zé"]), ("Lá vai D’Ávila da-Costa.", ["D'Ávila"]), ("“Maria” disse.", ["Maria"]),
])
def test_names(spark, text, names):
    df = spark.createDataFrame([(text,)], "t string")
    assert [x["name"] for x in df.select(P.name_chunks(F.col("t")).alias("x")).first()["x"]] == names


def test_folding_of_decomposed_letters(spark):
    for text in ("cafés São Ünïcode", "ﬁm ½ nº ª ① ２", "ḗ ṩ ǻ Ǆ", "œuvre ß ø ł"):
        for form in ("NFC", "NFD", "NFKD"):
            given = unicodedata.normalize(form, text)
            want = "".join(c for c in unicodedata.normalize("NFKD", given) if not unicodedata.combining(c)).lower()
            assert one(spark, T.fold("t"), t=given) == re.sub("[^a-z0-9]+", " ", want).strip()
            assert one(spark, T.fold_spacing("t"), t=given) == " ".join(want.split())


def test_text_metrics(spark):
    row = spark.createDataFrame([("Alguém viu o que aconteceu?",)], "t string").select(T.words("t"), T.inner_punctuation("t"), T.syllables("t")).first()
    assert row[0] == 5 and row[1] == 0 and row[2] >= 5


def test_replace_word_and_case(spark):
    assert one(spark, T.replace_word("t", "ação", "obra"), t="ação AÇÃO Ação reação") == "obra OBRA Obra reação"
    assert one(spark, T.preserve_case(F.col("a"), F.col("b")), a="PRONTO", b="pronta") == "PRONTA"
    assert one(spark, T.preserve_case(F.col("a"), F.col("b")), a="Pronto", b="pronta") == "Pronta"


def test_ids(spark):
    assert one(spark, T.hex_id("i"), i=2**32 - 1) == "0xffffffff"
    assert one(spark, T.normalize_id("t"), t=" 0X0000ABCD ") == "0x0000abcd"
    assert one(spark, T.normalize_id("t"), t="0x+0000abc") is None
    assert one(spark, T.parse_ident("t"), t="0xff") == 255 and one(spark, T.parse_ident("t"), t="4294967296") is None


def test_numbers(spark):
    assert one(spark, T.as_number("t"), t=" 1,5 ") == 1.5 and one(spark, T.as_number("t"), t="nan") is None and one(spark, T.as_number("t"), t="x") is None
    assert one(spark, T.human_size(F.col("n")), n=3 * 2**20) == "3.00 MiB"
    assert one(spark, T.vector_map("t"), t="a:1.5|b:2") == {"a": 1.5, "b": 2.0} and one(spark, T.vector_map("t"), t="a:1|b") is None
    assert one(spark, T.safe_name("t"), t="Olá, mundo / novo!") == "Ola_mundo_novo" and one(spark, T.safe_name("t"), t="???") == "termo"


@pytest.mark.parametrize(("text", "markers", "duration", "style", "confidence"), [
    ("As cavernas estão tranquilas agora?", "pergunta", 2.0, "investigacao_observacional", "alta"), ("O que foi?", "pergunta", 0.25, "alerta_tenso", "media"),
    ("Astúcia? E você acha isso digno de um cavaleiro?", "pergunta", 3.0, "ironia_seca", "alta"), ("palavra " * 25, "declarativa", 9.0, "narrativa_contida", "alta"),
    ("Tudo bem.", "declarativa", 1.0, "conversa_neutra", "media"),
])
def test_cascade(spark, text, markers, duration, style, confidence):
    row = one(spark, classify.cascade(F.col("t"), F.col("m"), F.col("d")), t=text, m=markers, d=duration)
    assert (row["style"], row["confidence"]) == (style, confidence)


def test_scores(spark):
    def best(text, duration=2.0):
        lines = spark.createDataFrame([(1, text, duration)], "i int, t string, d double")
        scored = classify.with_style_scores(lines, "i", "t", F.col("d"), lexicon.table(spark, classify.LEXICON))
        return scored.select(classify.decide(F.col("scores")).alias("x")).first()["x"]

    assert best("Há pegadas e sangue perto da caverna.")["style"] == "investigacao_observacional"
    assert best("Sinto falta dela. Descanse em paz.")["style"] == "tristeza_contida"
    assert best("Me sinto muito bem hoje.")["style"] == "conversa_neutra"
    assert best("Perdi tudo.")["style"] == "conversa_neutra"  # that entry can't match
    assert best("Tudo bem por aqui.")["second"] is not None


@pytest.mark.parametrize(("neutral", "best", "want"), [
    (1.5, 1.0, ("conversa_neutra", "media", "não", "nenhuma")), (1.5, 1.3, ("conversa_neutra", "media", "não", "nenhuma")), (1.5, 1.6, ("conversa_neutra", "baixa", "não", "nenhuma")),
    (1.5, 1.95, ("conversa_neutra", "baixa", "sim", "baixa")), (1.9, 2.0, ("ironia_seca", "baixa", "sim", "alta")), (1.5, 2.1, ("ironia_seca", "baixa", "sim", "media")), (1.5, 2.3, ("ironia_seca", "media", "não", "nenhuma")),
    (1.0, 5.0, ("ironia_seca", "alta", "não", "nenhuma")),
])
def test_review_priority(spark, neutral, best, want):
    scores = F.array(*[F.struct(F.lit(s).alias("name"), F.lit(neutral if s == "conversa_neutra" else best if s == "ironia_seca" else 0.0).alias("score")) for s in classify.STYLES])
    row = one(spark, classify.decide(scores, F.when(F.col("t") == "p", "alerta_tenso")), t="x")
    assert (row["style"], row["confidence"], row["review"], row["priority"]) == want
    known = one(spark, classify.decide(scores, F.when(F.col("t") == "p", "alerta_tenso")), t="p")
    assert (known["style"], known["top"], known["margin"], known["confidence"], known["review"], known["origin"]) == ("alerta_tenso", 99.0, 99.0, "alta", "não", "piloto_confirmado")


def test_refinement(spark):
    df = spark.createDataFrame(
        [("alerta_tenso", "pergunta_cautelosa", 3.0, 2.9, False, "baixa", "lento", "pausa_leve", "media"), ("tristeza_contida", "conversa_neutra", 2.0, 1.9, False, "baixa", "lento", "pausa_frequente", "media")],
        "style string, second string, top double, second_score double, has_cry boolean, intensity string, pace string, pauses string, duration_band string",
    )
    out = {r["style"]: r["style_refined"] for r in classify.refine(df).collect()}
    assert out == {"alerta_tenso": "pergunta_cautelosa", "tristeza_contida": "tristeza_contida"}


def test_long_lexicon(spark):
    """10,000 fragments of one to four words, some with any ending, against a search for each."""
    draw = random.Random(5)
    words = ["ab", "abc", "abcd", "b", "ba", "cab", "d", "dd", "x1"]
    fragments = sorted({" ".join(draw.choices(words, k=draw.randrange(1, 5))) + draw.choice(["", "*", " ", "*"]) for _ in range(40_000)})[:10_000]
    lists = {s: [(f, draw.randrange(1, 9) / 8) for f in fragments[i::2]] for i, s in enumerate(("one", "two"))}
    lists["one"].append(lists["one"][0])  # a fragment that is listed twice counts twice
    texts = [" ".join(draw.choices(words, k=draw.randrange(0, 12))) for _ in range(60)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {(r["i"], h["style"]): h["score"] for r in lexicon.fragment_scores(df, "i", "t", lexicon.table(spark, lists)).collect() for h in r["hits"]}
    stands = lambda f, t: not f.endswith(" ") and (f" {f[:-1]}" in f" {t} " if f.endswith("*") else f" {f} " in f" {t} ")
    want = {(i, s): sum(w for f, w in fs if stands(f, t)) for i, t in enumerate(texts) if t is not None for s, fs in lists.items()}
    assert got == {k: v for k, v in want.items() if v}
    assert lexicon.fragment_scores(df, "i", "t", lexicon.table(spark, {"one": [("*", 1.0)]})).count() == 0


def test_ways_to_find_fragments_agree(spark, monkeypatch):
    """Fragments are found alike by fronts and by runs, and by fronts a word isn't cut for each kind of fragment."""
    draw = random.Random(8)
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdefghij", "b", "ba", "zzzz", "zzzzz"]
    texts = [(i, " ".join(draw.choices(words, k=draw.randrange(0, 15)))) for i in range(80)] + [(80, None)]
    df = spark.createDataFrame(texts, "i int, t string")
    lists = {"one": [("abcdefghij"[:n] + "*", n / 4) for n in range(1, 11)] + [("zzzz", 1.0), ("ab a", 2.0)], "two": [("abcd zz*", 0.5), ("b", 0.25), ("b ba abc*", 3.0), ("zzzzz zzzz", 1.5)]}
    table = lexicon.table(spark, lists)
    made = lexicon.fragment_scores(df, "i", "t", table)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("substring") <= 2 * 4 + 1
    fronts = {r["i"]: r["hits"] for r in made.collect()}
    monkeypatch.setattr(lexicon, "SMALL", 0)
    assert fronts and fronts == {r["i"]: r["hits"] for r in lexicon.fragment_scores(df, "i", "t", table).collect()}
