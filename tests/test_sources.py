"""Readers, writers, resumption."""

import json

import pytest
from pyspark.sql import functions as F

from linecurate.operators import integrity
from linecurate.plans import prepare
from linecurate.sources import sinks, tables
from linecurate.streaming import resume


def test_lines(spark, tmp_path):
    (tmp_path / "l.txt").write_text("﻿; note\n1|00|x|Olá.\n\n2|00|\nx|y\n1|00|x|Olá.\n3|Adeus\n", encoding="utf-8")
    out = tables.read_lines(spark, str(tmp_path / "l.txt")).orderBy("line_no").collect()
    assert [(r["ident"], r["text"], r["line_no"]) for r in out] == [(1, "Olá.", 2), (1, "Olá.", 6), (3, "Adeus", 7)]
    assert {r["ident"] for r in tables.read_lines(spark, str(tmp_path / "l.txt"), need_text=False).collect()} == {1, 2, 3}


def test_line_numbers_go_on(spark, tmp_path):
    """From file to file if they are joined, and through all blocks of a file, wherever they are read."""
    (tmp_path / "l").mkdir()
    names = ["part-00000-x.txt", "part-99999-x.txt", "part-100000-x.txt"]
    for i, name in enumerate(names):
        (tmp_path / "l" / name).write_text("".join(f"{1000 * i + k}|{'y' * (k % 13)}z\n\n" for k in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        whole = {r["ident"]: r["line_no"] for r in tables.read_lines(spark, str(tmp_path / "l"), joined=True).collect()}
        each = {r["ident"]: r["line_no"] for r in tables.read_lines(spark, str(tmp_path / "l")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole == {1000 * i + k: 800 * i + 2 * k + 1 for i in range(3) for k in range(400)}
    assert each == {1000 * i + k: 2 * k + 1 for i in range(3) for k in range(400)}


def test_lines_are_written_by_several_tasks(spark, small, same_as_sql, monkeypatch, tmp_path):
    from linecurate.queries import source_queries

    monkeypatch.setattr(source_queries, "scratch", lambda *_: str(tmp_path / "lines"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same_as_sql(source_queries.line_files, source_queries.LINES_SQL)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "lines").glob("part-*"))) == 4


def test_line_files_of_odd_documents(spark, monkeypatch, tmp_path):
    """Documents without a text aren't numbered, as the SQL's condition comes before its window; ids may have 64 bits."""
    import duckdb

    from linecurate.queries import source_queries

    texts = ["one", None, "a|b\n\n c ", "", " \r\n| ", "\tx", "two\r", "|three", "\u00a0", None, "last"]
    ids = [7, -3, 0, 1, 2, 5_000_000_000, 2**32, -(2**63), 2**63 - 1, 3, 4]
    rows = [(i, t, None if i == 4 else "e\nn" if i == 0 else "en") for i, t in zip(ids, texts, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(source_queries, "scratch", lambda *_: str(tmp_path / "lines"))
    got = source_queries.line_files(spark, str(tmp_path)).select("ident", "text", "line_no").collect()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(f"select ident, text, line_no from ({source_queries.LINES_SQL})").fetchall()
    assert len(want) == 7 and sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("read", [lambda s, p: tables.read_lines(s, p, joined=True), lambda s, p: tables.read_report(s, p, "a string", delimiter="|")])
def test_files_are_cut_once(spark, capsys, tmp_path, read):
    """What gives lines their places and what uses them see the same blocks, so that cores that come or go between change nothing."""
    for i in range(6):
        (tmp_path / f"part-0000{i}.txt").write_text("a|b\n" + "".join(f"{1000 * i + k}|{'y' * (k % 13)}z\n" for k in range(300)))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
    try:
        out = read(spark, str(tmp_path))
        before = sorted(map(tuple, out.collect()))
        out.explain()
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        assert sorted(map(tuple, read(spark, str(tmp_path)).collect())) == before and len(before) == 1800
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert capsys.readouterr().out.count("FileScan text") < 2


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted"; text\nover lines', ""), (2, "b", "é")], "id int, text string, note string")
    sinks.write_report(df, str(tmp_path / "r"), ["id", "text", "note"], order=["id"])
    back = tables.read_report(spark, str(tmp_path / "r"), "id int, text string, note string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_report(df, str(tmp_path / "r"), ["id"])
    with pytest.raises(ValueError, match="missing"):
        tables.read_report(spark, str(tmp_path / "r"), "id int, other string")


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("0x1", "é", None), ("0x2", "b", 1.5)], "id string, text string, duration double")
    sinks.write_jsonl(df, str(tmp_path / "j"), ["id", "text", "duration"])
    lines = [json.loads(x) for p in (tmp_path / "j").glob("part*") for x in p.read_text().splitlines()]
    assert {"id": "0x1", "text": "é"} in lines
    back = tables.read_jsonl(spark, str(tmp_path / "j"), "id string, text string").collect()
    assert {(r["id"], r["text"]) for r in back} == {("0x1", "é"), ("0x2", "b")} and any("duration" in r["raw"] for r in back)


def test_listing_and_ids(spark, tmp_path):
    for n in ("0x00000001__a_falha.wav", "0x00000002__b.wav", "x.wav"):
        (tmp_path / n).write_bytes(b"1" * 50)
    out = {(r["g1"], r["g2"], r["g3"]) for r in tables.list_files(spark, str(tmp_path), tables.VARIANT_NAME).collect()}
    assert out == {("0x00000001", "a", "falha"), ("0x00000002", "b", "")}
    (tmp_path / "ids.txt").write_text("# c\n0x0000000A # first\n\n0x0000000b\n")
    assert [r["id"] for r in tables.read_ids(spark, str(tmp_path / "ids.txt")).orderBy("line_no").collect()] == ["0x0000000a", "0x0000000b"]


def test_package_order(spark):
    names = ["content0", "content10", "content2", "dlc10", "dlc2", "bob", "ep1", "other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    natural = [r["name"] for r in tables.package_order(df).orderBy("source_index").collect()]
    assert natural == ["content0", "content2", "content10", "bob", "dlc2", "dlc10", "ep1"]
    assert [r["name"] for r in tables.package_order(df, natural=False).orderBy("source_index").collect()][:3] == ["content0", "content10", "content2"]


def test_references(spark, tmp_path):
    text = sinks.references_toml([{"style": "a", "enabled": True, "ref_audio": "a.wav"}, {"style": "b", "enabled": False}], "a")
    (tmp_path / "r.toml").write_text(text)
    df, default = tables.read_references(spark, str(tmp_path / "r.toml"))
    assert default == "a" and {(r["style"], r["enabled"]) for r in df.collect()} == {("a", True), ("b", False)}
    (tmp_path / "r.toml").write_text(text.replace('padrao = "a"', 'padrao = "b"'))
    with pytest.raises(ValueError, match="default"):
        tables.read_references(spark, str(tmp_path / "r.toml"))


def test_resume(spark):
    items = spark.createDataFrame([(i,) for i in range(6)], "id int")
    outputs = spark.createDataFrame([(0, 100), (1, 10), (2, 90)], "id int, size int")
    good = F.col("size") > 44
    assert {r["id"] for r in resume.pending(items, outputs, "id", good).collect()} == {1, 3, 4, 5}
    assert resume.pending(items, outputs, "id", good, force=True).count() == 6
    assert {r["id"]: r["state"] for r in resume.status(items, outputs, "id", good).collect()} == {0: "valido", 1: "invalido", 2: "valido", 3: "pendente", 4: "pendente", 5: "pendente"}
    kinds = {r["id"]: r["kind"] for r in resume.retry_plan(items, outputs, "id", good, 2).collect()}
    assert kinds == {3: "preflight", 4: "lote", 5: "lote", 1: "individual"}


def test_stream_once(spark, tmp_path):
    seen = []
    (tmp_path / "in").mkdir()
    run = lambda: resume.stream_lines(spark, str(tmp_path / "in"), "id int", str(tmp_path / "check"), lambda df, _: seen.extend(r["id"] for r in df.collect())).awaitTermination()
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n')
    run()
    (tmp_path / "in" / "b.json").write_text('{"id": 2}\n')
    run()
    assert seen == [1, 2]


def test_manifest(spark):
    lines = spark.createDataFrame([(1, "*Suspira* Estou pronto.", 1), (2, "*Cof*", 2), (3, "Oi *você*.", 3), (3, "Oi *você*.", 4)], "ident long, text string, line_no int")
    fixes = spark.createDataFrame([], "ident long, action string, text string, reason string")
    times = spark.createDataFrame([(1, 1.0)], "ident long, duration double")
    out = {r["ident"]: r for r in prepare.manifest(lines, fixes, times).collect()}
    assert out[1]["final_text"] == "Estou pronto." and out[1]["review"] == "revisar_genero"
    assert out[2]["action"] == "usar_original" and out[3]["lines"] == [3, 4] and out[3]["review"] == "revisar_marcacao,duracao_ausente"
    with pytest.raises(ValueError, match="unknown"):
        prepare.manifest(lines, spark.createDataFrame([(9, "gerar", "x", "")], fixes.schema), times)
    with pytest.raises(ValueError, match="differ"):
        prepare.manifest(lines.union(spark.createDataFrame([(1, "Outra.", 5)], lines.schema)), fixes, times)


def test_findings_and_fixes(spark):
    schema = "ident long, action string, original string, text string"
    lines = spark.createDataFrame([(1, "gerar", "Argh. Estou pronto.", "Argh. Estou pronto."), (2, "gerar", "Argh!", "Argh!"), (3, "gerar", "*Cof* Vi o bruxa.", "Vi o bruxa."), (4, "usar_original", "Argh", "Argh")], schema)
    found = prepare.audit_findings(lines)
    assert {(r["ident"], r["category"]) for r in found.collect()} == {(1, "vocalizacao_ou_acao"), (1, "concordancia_feminina"), (2, "vocalizacao_ou_acao"), (3, "marcacao_ja_tratada"), (3, "concordancia_suspeita")}
    fixes = {r["ident"]: (r["action"], r["text"]) for r in prepare.safe_fixes(found).collect()}
    assert fixes == {1: ("gerar", "Estou pronta."), 2: ("usar_original", "")}
    legacy = {r["ident"]: r["text"] for r in prepare.safe_fixes(found, legacy_order=True).collect()}
    assert legacy[1] == "Estou pronto."
    edits = spark.createDataFrame([(1, 1, "nicht da", "x")], "ident long, seq int, old string, new string")
    with pytest.raises(ValueError, match="missing"):
        prepare.audit_findings(lines, edits)


def test_coverage_gate(spark):
    empty = spark.createDataFrame([], "ident long, status string")
    files = spark.createDataFrame([(1,), (2,), (9,)], "ident long")
    plan = lambda review: spark.createDataFrame([(1, "gerar", ""), (2, "gerar", review), (3, "usar_original", "")], "ident long, action string, review string")
    integrity.coverage_gate(integrity.coverage_labels(plan(""), files, files, empty, empty))
    with pytest.raises(ValueError, match="review"):
        integrity.coverage_gate(integrity.coverage_labels(plan("revisar_genero"), files, files, empty, empty))
    with pytest.raises(ValueError, match="incomplete"):
        integrity.coverage_gate(integrity.coverage_labels(plan(""), files, files.where("ident > 1"), empty, empty))
    assert [r["ident"] for r in integrity.too_small(spark.createDataFrame([(1, 44), (2, 45), (3, None)], "ident int, length int")).collect()] == [1, 3]
    with pytest.raises(ValueError, match="repeats"):
        integrity.join_unique(files, files.union(files), "ident")
