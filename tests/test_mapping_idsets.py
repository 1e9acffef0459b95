"""States of a mapping, id sets, and the edit cascade with its errors."""

import random

import pytest
from pyspark.sql import functions as F

from linecurate.functions import portuguese as P
from linecurate.operators import idsets, integrity, mapping, relational
from linecurate.plans import prepare

PLACES = "ident long, ident_high long, source_index int, entry_index int, path string, codec string, channels int, rate int, duration double, trailer_kind int, companion_bytes int, companion_sha256 string, error string"
NEW = "ident long, codec string, channels int, rate int, duration double, error string"


def place(ident, source=0, high=0, codec="wem-opus", seconds=1.0, kind=1, side="h", error=None):
    return (ident, high, source, 0, f"p{source}", codec, 1, 48000, seconds, kind, 4, side, error)


def test_all_states(spark):
    places = [
        place(1), place(2), place(2, 1, seconds=1.019), place(3), place(3, 1, high=9), place(3, 2, high=9), place(4), place(4, 1, high=1, kind=2), place(5), place(6), place(6, 1, error="cut"),
        place(8), place(9), place(10, seconds=0.0), place(11, seconds=1.0), place(11, 1, seconds=1.03), place(99),
    ]
    new = [(i, "pcm" if i == 5 else "wem-opus", 1, 48000, 2.0, "bad" if i == 9 else None) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)]
    places, new = spark.createDataFrame(places, PLACES), spark.createDataFrame(new, NEW)
    states = mapping.mapped(new, places, spark.createDataFrame([(8,), (8,)], "ident long"))
    rows = {r["ident"]: r for r in states.collect()}
    assert {i: r["status"] for i, r in rows.items()} == {
        1: "ok", 2: "duplicado_equivalente", 3: "id_high_expandido", 4: "duplicado_divergente", 5: "incompatível", 6: "erro", 7: "ausente", 8: "ignorado", 9: "erro", 10: "ok", 11: "duplicado_divergente",
    }
    assert rows[4]["differences"] == "id_high, trailer_kind" and rows[11]["differences"] == "duração" and rows[3]["entries"] == 2
    assert rows[5]["problems"] == "codec wem-opus -> pcm; substituto não é WEM Opus: pcm" and rows[10]["delta_pct"] == 0.0 and rows[1]["delta_pct"] == 100.0
    assert rows[2]["detail"] == "2 cópias equivalentes; selecionado p1" and rows[6]["detail"] == "cut" and rows[9]["detail"] == "bad"
    got = sorted((r["ident"], r["ident_high"], r["source_index"]) for r in mapping.taken(states, places).collect())
    assert got == [(1, 0, 0), (2, 0, 1), (3, 0, 0), (3, 9, 2), (10, 0, 0)]
    assert {r["status"] for r in mapping.mapped(new, places.limit(0)).collect()} == {"ausente", "erro"} - {"erro"}
    assert mapping.mapped(new.limit(0), places).count() == 0


def test_id_sets(spark):
    draw = random.Random(1)
    sets = {n: {draw.randrange(70_000) for _ in range(3000)} | {2**31 + i for i in range(k)} for k, n in enumerate("abc")} | {"none": set()}
    frames = {n: spark.createDataFrame([(i,) for i in s] + [(i,) for i in list(s)[:50]], "k long") for n, s in sets.items()}
    got = {(r["a"], r["b"]): (r["both"], r["either"], r["only_a"], r["only_b"]) for r in idsets.overlaps(frames, "k").collect()}
    names = list(sets)
    assert got == {(x, y): (len(sets[x] & sets[y]), len(sets[x] | sets[y]), len(sets[x] - sets[y]), len(sets[y] - sets[x])) for i, x in enumerate(names) for y in names[i + 1 :]}
    rows = {r["k"]: tuple(r[1:]) for r in idsets.memberships(frames, "k").collect()}
    assert rows == {k: tuple(k in sets[n] for n in names) for k in set().union(*sets.values())}
    sides = {(r["k"], r["side"]) for r in relational.key_differences(frames["a"], frames["b"], "k").collect()}
    assert sides == {(k, "left") for k in sets["a"] - sets["b"]} | {(k, "right") for k in sets["b"] - sets["a"]}
    texts = idsets.memberships({"x": spark.createDataFrame([("a",), (None,)], "t string"), "y": spark.createDataFrame([(None,)], "t string")}, "t")
    assert {(r["t"], r["x"], r["y"]) for r in texts.collect()} == {("a", True, False), (None, True, True)}


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", None), (1, None, None), (2, "b", 3)], "g int, x string, y int")
    assert {tuple(r) for r in integrity.distinct_profiles(df, "g", "x", "y").collect()} == {(1, 4, 3), (2, 1, 1)}


def cascade(spark, text, grouped=False, word=None, self_=False, phrase=None):
    lines = spark.createDataFrame([(1, text, "")], "ident long, text string, flag string")
    some = lambda on: lines.select("ident") if on else lines.select("ident").limit(0)
    listed = lambda pair: spark.createDataFrame([(1, 1, *pair)] if pair else [], "ident long, seq int, old string, new string")
    rules = P.cascade_rules(lines, "ident", some(grouped), listed(word), some(self_), listed(phrase))
    empty = spark.createDataFrame([], "ident long, reason string")
    return prepare.gender_decisions(lines, rules, empty, empty).select("final", F.regexp_replace("reason", "^[^:]*: ", "").alias("why")).first()


def test_edit_cascade(spark):
    assert tuple(cascade(spark, "Obrigado, um bruxo!", grouped=True)) == ("Obrigada, uma bruxa!", "obrigado→obrigada; bruxo→bruxa (autorreferência).")
    assert tuple(cascade(spark, "Nada.", grouped=True))[0] == "Nada."
    assert tuple(cascade(spark, "Fui eu  mesmo. MESMO?", self_=True)) == ("Fui eu  mesma. MESMA?", "mesmo→mesma (autorreferência).")
    with pytest.raises(ValueError, match="missing"):
        cascade(spark, "Ele mesmo.", self_=True)
    with pytest.raises(ValueError, match="missing"):
        cascade(spark, "Nada.", word=("pronto", "pronta"))
    assert tuple(cascade(spark, "Estou Pronto. Vou só.", word=("pronto", "pronta"), phrase=("só", "sozinha"))) == ("Estou Pronta. Vou sozinha.", "pronto→pronta; só→sozinha.")
