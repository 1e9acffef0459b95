"""Operators on small tables, against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from linecurate.operators import integrity, relational, scan, scoring, sequences, stats


def plan(spark, original, trimmed):
    return spark.createDataFrame([(original, trimmed)], "o double, t double").select(scoring.duration_plan(F.col("o"), F.col("t"), least_ratio=0.80).alias("p")).first()["p"]


def test_duration_plan(spark):
    p = plan(spark, 3.635833, 4.934503)
    assert p["status"] == "ok" and 1.17 < p["speed"] < 1.20 and 14 < p["delta_pct"] < 15
    p = plan(spark, 3.0, 5.0)
    assert p["speed"] == 1.20 and p["status"] == "revisar_longa"
    assert plan(spark, 2.0, 1.0)["status"] == "revisar_curta"
    p = plan(spark, 0.255566, 0.84)
    assert p["status"] == "ok" and p["speed"] == 1.20


def test_final_status(spark):
    df = spark.createDataFrame([(2.0, 1.0), (3.0, 5.0), (2.0, 2.1)], "o double, f double")
    soft = [r[0] for r in df.select(scoring.final_status(F.col("o"), F.col("f"))).collect()]
    hard = [r[0] for r in df.select(scoring.final_status(F.col("o"), F.col("f"), strict=True)).collect()]
    assert soft == ["aviso_curta", "aviso_longa", "ok"] and hard == ["revisar_curta", "revisar_longa", "ok"]


def test_exact_length(spark):
    df = spark.createDataFrame([(1.20,), (0.96,), (0.80,), (1.0,)], "d double")
    assert [r[0]["action"] for r in df.select(scoring.exact_length_plan(F.col("d"), F.lit(1.0))).collect()] == ["aparar", "preencher", "rejeitar", "manter"]


def test_version_summary(spark):
    pairs = spark.createDataFrame([(1, 5.0, 4.0, 20.0, 18.0, 0.8, 1.0, 0.1, 0.2)], "g int, old_pitch double, new_pitch double, old_energy double, new_energy double, old_duration double, new_duration double, old_pause double, new_pause double")
    row = scoring.version_summary(pairs, "g").first()
    assert row["duration_ratio"] == pytest.approx(0.8) and row["remarks"] == "altura mais variada | energia maior | mais curta | menos pausas"


def test_null_measures_give_no_priority(spark):
    df = spark.createDataFrame([(None, 0.9)], "f double, u double")
    assert df.select(scoring.identity_priority(F.col("f"), F.col("u"), F.col("u"), F.col("u"), F.lit(0.0), F.lit(False))).first()[0] == "ok"


def test_ecdf_and_running_total(spark):
    values = [random.Random(1).randrange(40) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    got = {r["i"]: r["percentile"] for r in stats.ecdf(df, "v").collect()}
    assert all(got[i] == pytest.approx(100 * sum(w <= v for w in values) / len(values)) for i, v in enumerate(values))
    total = {r["i"]: r["before"] for r in scan.running_total(df, "v", "i", pieces=7).collect()}
    assert all(total[i] == sum(values[:i]) for i in range(len(values)))


def test_ecdf_of_nothing(spark):
    empty = spark.createDataFrame([], "i int, v double")
    assert stats.ecdf(empty, "v").count() == 0
    some = spark.createDataFrame([(1, None), (2, 3.0)], "i int, v double")
    assert {r["i"]: r["percentile"] for r in stats.ecdf_against(some, "v", empty, "v").collect()} == {1: None, 2: None}


def test_robust_z_falls_back(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (5.0,)], "v double")
    z = sorted(r["z"] for r in stats.robust_z(df, "v").collect())
    assert z[-1] == pytest.approx(4 / statistics.pstdev([1, 1, 1, 5])) and z[0] == 0
    assert {r["z"] for r in stats.robust_z(df.where("v = 1"), "v").collect()} == {0.0}


def test_run_counts(spark):
    mask = [False, True, True, False, True, True, True, False]
    df = spark.createDataFrame([(1, i, m) for i, m in enumerate(mask)], "g int, i long, m boolean")
    assert sequences.count_runs(df, "g", "i", F.col("m"), 3).first()["runs"] == 1
    assert [r["flag"] for r in sequences.bridged(df, "g", "i", F.col("m"), 1).orderBy("i").collect()] == [False] + [True] * 6 + [False]


def test_merge_statuses(spark):
    s = "id int, action string, text string, reason string"
    base = spark.createDataFrame([(1, "usar_original", "", "a"), (2, "gerar", "x", "a"), (3, "gerar", "y", "a b"), (5, "gerar", "z", "")], s)
    over = spark.createDataFrame([(1, "gerar", "n", "b"), (2, "gerar", "x", "a"), (3, "gerar", "w", "b"), (4, "gerar", "v", "c")], s)
    out = {r["id"]: (r["status"], r["text"], r["reason"]) for r in relational.merge_corrections(base, over).collect()}
    assert out == {1: ("conflito_mantido_base", "", "a"), 2: ("inalterado", "x", "a"), 3: ("atualizado", "w", "a b"), 4: ("adicionado", "v", "c"), 5: ("base", "z", "")}


def test_systematic_sample(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 101)], "id int, duration double")
    got = relational.systematic_sample(df, "id", "duration", 10, [42]).collect()
    assert len(got) == 10 and min(r["duration"] for r in got) == 1 and max(r["duration"] for r in got) >= 90 and 42 in {r["id"] for r in got}
    assert relational.systematic_sample(df, "id", "duration", 2, [42]).count() == 2
    assert relational.systematic_sample(df.limit(3), "id", "duration", 10).count() == 3


def test_require_none(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(integrity.IntegrityError, match="repeated"):
        integrity.require_none(integrity.duplicates(df, "k"), "repeated keys")
    integrity.require_none(integrity.duplicates(df.distinct(), "k"), "repeated keys")


def test_occurrence_status(spark):
    df = spark.createDataFrame([(1, 0, 0, "a"), (2, 0, 1, "a"), (2, 0, 2, "a"), (3, 0, 3, "a"), (3, 1, 4, "a"), (4, 0, 5, "a"), (4, 0, 6, "b")], "id int, high int, at int, hash string")
    out = {r["id"]: (r["status"], r["chosen"]["at"]) for r in integrity.occurrence_status(df, "id", "high", ["at"], ["hash"]).collect()}
    assert out == {1: ("ok", 0), 2: ("duplicado_equivalente", 2), 3: ("id_high_expandido", 4), 4: ("duplicado_divergente", 6)}
    first = {r["id"]: r["chosen"]["at"] for r in integrity.occurrence_status(df, "id", "high", ["at"], ["hash"], keep="first").collect()}
    assert first[2] == 1
