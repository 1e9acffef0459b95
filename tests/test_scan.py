"""Places and prefix sums in one order: text, timestamp and hot keys, nulls, equal rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from linecurate.operators import scan, sequences


def rows_of(kind):
    draw = random.Random(3)
    keys = {
        "text": lambda i: draw.choice(["", "é", "Z", "a", None, f"k{i}"]),
        "timestamp": lambda i: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=draw.randrange(500)),
        "hot": lambda i: 7 if i % 20 else i,
    }
    return [(i, keys[kind](i), draw.randrange(9)) for i in range(2000)]


@pytest.mark.parametrize("kind, schema", [("text", "i int, k string, v int"), ("timestamp", "i int, k timestamp, v int"), ("hot", "i int, k int, v int")])
def test_places_and_sums(spark, kind, schema):
    rows = rows_of(kind)
    df = spark.createDataFrame(rows, schema)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1].encode() if isinstance(r[1], str) else r[1] or 0, r[0]))
    want, at = {}, 0
    for place, r in enumerate(order):
        want[r[0]] = (place, at)
        at += r[2]
    both = scan.running_total(scan.numbered(df, "k", "i", pieces=8), "v", "k", "i", pieces=8)
    assert {r["i"]: (r["place"], r["before"]) for r in both.collect()} == want
    sizes = [r["count"] for r in scan.ranges(df, "k", pieces=8).groupBy("__piece").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * len(rows) / 8


def test_equal_rows_are_split(spark):
    df = spark.createDataFrame([(1, "x")] * 1000 + [(2, "y")], "k int, t string")
    sizes = [r["count"] for r in scan.ranges(df, "k", pieces=8).groupBy("__piece").count().collect()]
    assert max(sizes) <= 2 * 1001 / 8
    assert sorted(r["place"] for r in scan.numbered(df, F.col("k").desc(), pieces=8).collect()) == list(range(1001))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "k string, v long")
    assert scan.numbered(empty, "k").count() == 0 and scan.running_total(empty, "v", "k").count() == 0
    df = spark.createDataFrame([(None, None), ("a", 4), (None, 2), ("b", None)], "k string, v long")
    assert sorted((r["k"] or "", r["before"]) for r in scan.running_total(df, "v", "k").collect() if r["k"]) == [("a", 2), ("b", 6)]


def test_batches_by_text(spark):
    df = spark.createDataFrame([(c,) for c in "dbacfe"], "k string")
    assert {r["k"]: r["batch"] for r in sequences.batches(df, "k", 2).collect()} == {"a": 0, "b": 0, "c": 1, "d": 1, "e": 2, "f": 2}
