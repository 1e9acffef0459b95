"""Quoted reports read in blocks equal those read whole."""

import csv
import random

import pytest

from linecurate.sources import reports, tables

SCHEMA = "a string, b string, c string"


def written(path, seed, rows=400, ends="\n"):
    draw = random.Random(seed)
    pieces = ['"', '""', ";", "\n", "x", "é", " ", "\r\n", "lorem ipsum ", ""]
    cells = [["".join(draw.choices(pieces, k=draw.randrange(9))) for _ in range(3)] for _ in range(rows)]
    for i, r in enumerate(cells):
        r[0] = f"k{i}" + r[0]
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, delimiter=";", lineterminator=ends)
        w.writerows([["a", "b", "c"], *cells])
    return sorted(map(tuple, cells))


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_blocks_and_whole_files(spark, tmp_path, ends):
    want = sorted(written(tmp_path / "one.csv", 1, ends=ends) + written(tmp_path / "two.csv", 2, 30, ends=ends))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = tables.read_report(spark, str(tmp_path), SCHEMA)
        assert reports.records(spark, str(tmp_path)).select("file").distinct().count() == 2
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        rows = sorted(tuple(r) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == want
    if ends == "\n":  # Spark's own reader changes the ends of lines in cells to those of the file
        whole = spark.read.csv(str(tmp_path), sep=";", header=True, quote='"', escape='"', multiLine=True, schema=SCHEMA, mode="FAILFAST").na.fill("")
        assert sorted(tuple(r) for r in whole.collect()) == want


def test_odd_reports(spark, tmp_path):
    (tmp_path / "h.csv").write_text('﻿a;b\n\n1;"x\n\ny"\n2;\n', encoding="utf-8")
    read = lambda name, schema, **kw: sorted(tuple(r) for r in tables.read_report(spark, str(tmp_path / name), schema, **kw).collect())
    assert read("h.csv", "b string, a int") == [("", 2), ("x\n\ny", 1)]
    with pytest.raises(ValueError, match="columns missing: z"):
        read("h.csv", "z string")
    (tmp_path / "n.csv").write_text("1,2\n3,4\n")
    assert read("n.csv", "a int, b int", header=False, delimiter=",") == [(1, 2), (3, 4)]
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("a;b\n1;2\n")
    (tmp_path / "two" / "b.csv").write_text("b;a\n1;2\n")
    with pytest.raises(ValueError, match="different headers"):
        read("two", "a int")
    with pytest.raises(Exception):
        (tmp_path / "short.csv").write_text("a;b\n1\n")
        read("short.csv", "a int, b int")
