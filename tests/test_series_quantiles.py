"""Exact percentiles without one buffer, and runs in one long series."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecurate.operators import quantiles, sequences, series, stats


@pytest.mark.parametrize("small", [100_000, 50])
def test_quantiles_by_group(spark, small):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "a", "a", None, "b"]), draw.choice([None, draw.randrange(20) / 4, draw.gauss(0, 100), 7.0])) for _ in range(4000)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.1, 1 / 3, 0.5, 0.66667, 0.999, 1.0]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in quantiles.quantiles(df, "v", shares, "g", small=small).collect()}
    for g in {g for g, _ in rows}:
        values = [v for h, v in rows if h == g and v is not None]
        assert got[g][0] == len(values)
        assert got[g][1] == pytest.approx(list(np.percentile(values, [100 * s for s in shares]))) if values else got[g][1] is None
    assert len(got) == len({g for g, _ in rows})


def test_quantiles_of_all(spark):
    values = [((i * 7919) % 5003) / 10 for i in range(5003)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    for small in (10, 10**6):
        row = quantiles.quantiles(df, "v", [0.25, 0.5, 0.9001], small=small).collect()
        assert len(row) == 1 and row[0]["quantiles"] == pytest.approx(list(np.percentile(values, [25, 50, 90.01])))
    assert [(r["n"], r["quantiles"]) for r in quantiles.quantiles(df.limit(0), "v", [0.5]).collect()] == [(0, None)]
    same = spark.createDataFrame([(1.5,)] * 500, "v double")
    assert quantiles.quantiles(same, "v", [0.5, 0.9], small=10).first()["quantiles"] == [1.5, 1.5]


def test_robust_scores_of_large_groups(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id", "id % 3 as g", "cast((id * 37) % 1009 as double) as v")
    want = [(r["id"], r["z"]) for r in stats.robust_z(df, "v").orderBy("id").collect()], [(r["g"], r["median"], r["scale"]) for r in stats.group_scale(df, "g", "v").orderBy("g").collect()]
    monkeypatch.setattr(stats, "SMALL", 20)
    got = [(r["id"], r["z"]) for r in stats.robust_z(df, "v").orderBy("id").collect()], [(r["g"], r["median"], r["scale"]) for r in stats.group_scale(df, "g", "v").orderBy("g").collect()]
    assert got == want


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_long_series(spark):
    draw = random.Random(4)
    data = [(g, i, draw.random() < 0.6, draw.randrange(50)) for g, n in (("long", 900), ("x", 40), ("y", 1)) for i in range(n)]
    data += [("flat", i, True, 1) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i long, f boolean, v int").repartition(3)
    flag = F.col("f")
    pick = lambda out, *c: rows(out.select(*c))
    for pieces in (1, 8, 200):
        assert pick(series.runs(df, "g", "i", flag, pieces), "g", "flag", "start", "end", "length") == pick(sequences.runs(df, "g", "i", flag), "g", "flag", "start", "end", "length")
    assert rows(series.bridged(df, "g", "i", flag)) == rows(sequences.bridged(df, "g", "i", flag))
    assert rows(series.count_runs(df, "g", "i", flag, 3)) == rows(sequences.count_runs(df, "g", "i", flag, 3))
    assert rows(series.short_islands(df, "g", "i", flag, 2, 1)) == rows(sequences.short_islands(df, "g", "i", flag, 2, 1))
    assert rows(series.k_of_n_edges(df, "g", "i", flag, 3, 4)) == rows(sequences.k_of_n_edges(df, "g", "i", flag, 3, 4))
    assert pick(series.first_differences(df, "g", "i", "v"), "g", "i", "step") == pick(sequences.first_differences(df, "g", ["i"], "v"), "g", "i", "step")
    sizes = [r["count"] for r in series.segments(df, "g", "i", pieces=8).where("__own").groupBy("__segment").count().collect()]
    assert max(sizes) <= -(-len(data) // 8)
    assert series.runs(df.limit(0), "g", "i", flag).count() == 0
