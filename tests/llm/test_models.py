"""Language-model scores, toxicity, the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from linecurate.llm import attention, lm_scoring, toxicity
from linecurate.llm import textblocks as tb
from linecurate.llm.textblocks import lowered


def words(text):
    return [*re.findall(rb"[^\x20\x09-\x0d]+", lowered(text)), None]


def test_scorer_sums_to_one_and_agrees_with_gradients():
    rng = np.random.default_rng(1)
    model = attention.Model.fresh(np.arange(1, 97))
    model.parts["wc"] += rng.normal(size=model.parts["wc"].shape).astype(np.float32)
    texts = [rng.integers(0, 96, n).astype(np.int32) for n in (1, 15, 16, 17, 70)]
    inputs, targets, owner = attention.windows(texts, model.size)
    assert [int((targets[owner == i] >= 0).sum()) for i in range(5)] == [1, 15, 16, 17, 70]  # each item once
    logs = attention.log_probs(model, inputs, targets)
    _, loss = attention.gradients(model, inputs, targets)
    assert -logs.sum() / (targets >= 0).sum() == pytest.approx(loss, rel=1e-4)
    total = sum(np.exp(attention.log_probs(model, inputs[:1], np.where(np.arange(16) == 0, i, -1)[None].astype(np.int32))[0, 0]) for i in range(96))
    assert total == pytest.approx(1, rel=1e-4)


def test_model_is_causal():
    model = attention.Model.fresh(np.ones(64))
    text = np.arange(60, dtype=np.int32)
    other = text.copy()
    other[41:] = 3
    a, b = (attention.log_probs(model, *attention.windows([t], model.size)[:2]).ravel() for t in (text, other))
    assert np.allclose(a[:41], b[:41], atol=1e-5) and not np.allclose(a[41:60], b[41:60])


def test_gradients():
    rng = np.random.default_rng(2)
    model = attention.Model.fresh(np.ones(64))
    inputs, targets, _ = attention.windows([rng.integers(0, 64, 40).astype(np.int32)], model.size)
    g, _ = attention.gradients(model, inputs, targets)
    for name in attention.Model.names:
        a = model.parts[name]
        at = np.unravel_index(np.argmax(np.abs(g[name])), a.shape)
        keep, step = a[at], np.float32(2e-2)
        a[at] = keep + step
        up = attention.gradients(model, inputs, targets)[1]
        a[at] = keep - step
        down = attention.gradients(model, inputs, targets)[1]
        a[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(g[name][at], rel=0.1, abs=2e-4), name


def test_training_learns_what_follows():
    text = np.tile(np.array([1, 2, 3, 4, 5, 6, 7], np.int32), 60)
    model = attention.Model.fresh(np.bincount(text, minlength=32))
    inputs, targets, _ = attention.windows([text], model.size)
    before = attention.gradients(model, inputs, targets)[1]
    after = attention.gradients(attention.train(model, inputs, targets, 120, 1e-2), inputs, targets)[1]
    assert after < 0.3 * before


def base_by_hand(rows):
    docs = [(i, words(t)) for i, t in rows]
    counts = Counter(w for i, ws in docs for w in ws if i is not None and zlib.crc32(str(i).encode()) % 7 != 2)
    total, kinds = sum(counts.values()), len(counts)
    return [(i, len(ws), sum(w in counts for w in ws), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws)) for i, ws in docs]


def test_base_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_WORDS", 2000)
    monkeypatch.setattr(lm_scoring, "COMMON", 1e-3)
    rows = [(i, prose(i % 30, 20 + i % 50)) for i in range(120)]
    out = lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), lm_scoring.TOKENIZER).orderBy("doc_id").collect()
    for r, (i, tokens, known, total, base) in zip(out, base_by_hand(rows)):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, tokens, known, total) and r["base_score"] == pytest.approx(base)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and r["score"] < 0


def test_scores_of_odd_rows(spark, odd_documents, no_documents):
    out = lm_scoring.lm_scores(odd_documents, lm_scoring.TOKENIZER).collect()
    assert len(out) == odd_documents.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (2, 3, 4)} == {1}
    assert lm_scoring.lm_scores(no_documents, lm_scoring.TOKENIZER).count() == 0
    nothing_learned = lm_scoring.lm_scores(odd_documents.where("doc_id is null"), lm_scoring.TOKENIZER).collect()
    assert [r["base_score"] for r in nothing_learned] == [0.0]


def test_a_pass_sees_every_window(monkeypatch):
    seen, real = [], attention._gradients
    monkeypatch.setattr(attention, "_gradients", lambda parts, lags, ids, opens, targets: seen.extend(targets[..., 0].ravel().tolist()) or real(parts, lags, ids, opens, targets))
    inputs, targets, _ = attention.windows([np.array([i], np.int32) for i in range(383)], 384)
    attention.train(attention.Model.fresh(np.ones(384)), inputs, targets, 1, 1e-2)
    assert sorted(x for x in seen if x >= 0) == list(range(383))


def ranks():
    with open(lm_scoring.TOKENIZER, "rb") as file:
        return file.read()


def subword_counts(texts):
    plain = lm_scoring.Tokens(ranks())
    return np.bincount(np.concatenate([plain(tb.lowered(t)) for t in texts]), minlength=len(plain.number))


def test_every_character_is_a_subword():
    tokens = lm_scoring.Tokens(ranks())
    ids = np.argsort(tokens.number)
    for text in ("a\u00a0b\u3000c", "\u2028", "x\u0085y " + "\u00a0" * 700, "ção 你好"):
        assert tokens.encoding.decode([int(ids[n]) for n in tokens(tb.lowered(text))]) == "".join(" " + w.decode() for w in tb.lowered(text).split())


@pytest.mark.parametrize("memo", [600_000, 5])
def test_new_words_are_encoded_in_one_call(monkeypatch, memo):
    """With the subwords of words encoded one by one, also where the memo is full and where words are long."""
    monkeypatch.setattr(lm_scoring, "_MEMO", memo)
    raws = [tb.lowered(t) for t in (prose(1, 300), prose(2, 300), "", None, "ção 你好 \U0001f600 \u3000a\u00a0b", "y" * 63 + " " + "z" * 64 + " " + "字" * 700, "one one two")]
    tokens, calls = lm_scoring.Tokens(ranks()), []
    for name in ("encode_ordinary", "encode_to_numpy"):
        monkeypatch.setattr(type(tokens.encoding), name, lambda self, text, real=getattr(type(tokens.encoding), name): calls.append(text) or real(self, text))
    got = tokens.all(raws)
    assert len(calls) == 1 + 1 + 3  # all words; the two long ones, of 65 characters and of 701, by parts
    plain = lm_scoring.Tokens(ranks())
    for raw, numbers in zip(raws, got):
        each = [plain.number[plain.encoding.encode_ordinary(x[k : k + 256])] for x in (" " + w.decode() for w in raw.split()) for k in range(0, len(x), 256)]
        assert numbers.tolist() == np.concatenate([np.zeros(0, np.int32), *each]).tolist()
    assert len(tokens.memo) <= memo + len(tokens.memo.passing)


def test_counted_words_and_subwords(monkeypatch):
    """Counts of a task that flushes often, against counting word by word."""
    import pandas as pd

    monkeypatch.setattr(lm_scoring, "_FLUSH_WORDS", 40)
    texts = [prose(i % 7, 30) for i in range(40)] + ["", None, "ção " * 9, "x" * 700]
    shared = type("Shared", (), {"value": ranks()})
    out = pd.concat(lm_scoring._count(shared)(iter([pd.DataFrame({"text": texts[:25]}), pd.DataFrame({"text": texts[25:]})])))
    got = out.groupby(["kind", "h"])["c"].sum()
    raws = [tb.lowered(t) for t in texts]
    hashes = Counter(tb.word_hashes(raws)[0].view(np.int64).tolist())
    subwords = subword_counts(texts)
    assert got[0].to_dict() == hashes and got[1].to_dict() == {int(i): int(subwords[i]) for i in np.flatnonzero(subwords)}


@pytest.mark.parametrize("many", [1, 5, 10**9])
def test_rows_are_added_up_by_place(monkeypatch, many):
    monkeypatch.setattr(attention, "_MANY", many)
    rng = np.random.default_rng(4)
    places, rows = np.minimum(rng.integers(0, 40, 700) ** 2 // 40, 37).astype(np.int32), rng.normal(size=(700, 6)).astype(np.float32)
    want = np.stack([np.bincount(places, weights=rows[:, i], minlength=50) for i in range(6)], axis=1)
    assert np.allclose(attention._sums(places, rows, 50), want, atol=1e-4)


@pytest.mark.parametrize("tasks", [20_000, 3])
def test_every_training_document_is_learned_from(spark, monkeypatch, tasks):
    """Also where a task trains several shards."""
    monkeypatch.setattr(lm_scoring, "SHARD_WORDS", 300)
    monkeypatch.setattr(lm_scoring, "MAX_TASKS", tasks)

    def learned(changed):
        rows = [(i, prose(i + 500 * (i == changed), 50)) for i in range(60)]
        return lm_scoring.train_model(spark.createDataFrame(rows, "doc_id long, text string"), 3000, ranks(), subword_counts([t for _, t in rows]))

    plain = learned(None)
    for i in (5, 23, 41, 58):
        other = learned(i)
        assert max(np.abs(other.parts[k] - plain.parts[k]).max() for k in ("wc", "wp")) > 1e-5
    monkeypatch.setattr(lm_scoring, "SHARD_WORDS", 1)  # no document is drawn for so short a start
    rows = [(1, prose(1, 50)), (2, prose(2, 50))]
    assert lm_scoring.train_model(spark.createDataFrame(rows, "doc_id long, text string"), 100, ranks(), subword_counts([t for _, t in rows])).size >= 20


def test_shards_of_a_task_are_trained_one_by_one():
    tokens = lm_scoring.Tokens(ranks())
    import pandas as pd

    batches = [pd.DataFrame({"key": [5, 6, 7], "shard": [0, 0, 1], "text": ["a", "b", "c"]}), pd.DataFrame({"key": [8, 9], "shard": [1, 2], "text": ["d", "e"]})]
    assert [(key, len(texts)) for key, texts in lm_scoring._shards(iter(batches), tokens)] == [(5, 2), (7, 2), (9, 1)]


def plain_score(model, tokens, raw):
    """log10 probability of a text by a forward pass over one position after another."""
    p, numbers = {k: v.astype(np.float64) for k, v in model.parts.items()}, tokens(raw)
    wanted = tokens.model_items(numbers)
    before = np.concatenate(([model.size], wanted[:-1]))
    total = sum(tokens.logs[n] for n in numbers)
    for i, target in enumerate(wanted):
        seen = range(max(0, (i // attention.STEP - 1) * attention.STEP), i + 1)
        score = np.array([p["query"][before[i]] @ p["key"][before[j]] / math.sqrt(attention.KEY) + p["lag"][i - j] for j in seen])
        weight = np.exp(score - score.max())
        mixed = (weight / weight.sum()) @ p["value"][before[list(seen)]]
        h = np.maximum(0, mixed + p["self"][before[i]])
        for z, k in ((h @ p["wc"] + p["bc"], target // attention.PLACES), (h @ p["wp"][target // attention.PLACES] + p["bp"][target // attention.PLACES], target % attention.PLACES)):
            total += z[k] - z.max() - math.log(np.exp(z - z.max()).sum())
    return total / math.log(10)


def test_scores_are_those_of_a_plain_pass(spark, monkeypatch):
    """A table's scores against a forward pass that knows neither windows nor tables, with the model that was learned."""
    made, real = [], lm_scoring.train_model
    monkeypatch.setattr(lm_scoring, "train_model", lambda *a: made.append((real(*a), a)) or made[0][0])
    rows = [(i, prose(i, 7 + 9 * i)) for i in range(12)] + [(50, ""), (51, None), (52, "x" * 700), (53, "ção 你好 \U0001f600 zebra")]
    out = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), lm_scoring.TOKENIZER).collect()}
    (model, (_, _, raw, counts)), = made
    tokens = lm_scoring.Tokens(raw, counts)
    for i, text in rows:
        assert out[i] == pytest.approx(plain_score(model, tokens, tb.lowered(text)), rel=1e-4)


def test_scores_of_held_out_texts_beat_unigrams(spark, small):
    """Against the same subwords' add-one unigram probabilities; and reruns on other partitions agree."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").where("text is not null")
    texts = {r["doc_id"]: tb.lowered(r["text"]) for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    plain = lm_scoring.Tokens(ranks())
    counts = np.bincount(np.concatenate([plain(t) for i, t in texts.items() if i not in held]), minlength=len(plain.number))
    ends = len(texts) - len(held)
    space = counts.sum() + ends + len(counts) + 1
    unigram = {i: (np.log10((counts[plain(texts[i])] + 1) / space).sum() + math.log10((ends + 1) / space)) for i in held}
    runs = [{r["doc_id"]: r["score"] for r in lm_scoring.lm_scores(df, lm_scoring.TOKENIZER).collect()} for df in (docs, docs.repartition(3))]
    assert runs[0] == pytest.approx(runs[1], rel=1e-6)  # batches of another size round otherwise
    assert sum(runs[0][i] for i in held) > 0.9 * sum(unigram.values())


def test_words_without_blanks_count_whole():
    """A term counts wherever it stands in a run of letters without blanks."""
    long = "字" * 60 + "、" + "trash" + "\u00a0" + "文" * 60
    found = toxicity.text_features(long)
    assert b"=trash" in found and "~字字字字".encode() in found and "~文文文文".encode() in found
    assert "~坏词坏词".encode() in toxicity.text_features("字" * 100 + "坏词坏词" + "字" * 100)
    assert toxicity.text_features("x" * 300_000) == {b"~xxxx"}


def test_sample_is_bounded_by_rows(spark):
    """A doc_id with very many rows gives no more rows than the sample has."""
    rows = [(1, prose(i % 50, 20)) for i in range(400)] + [(i, "trash " + prose(i, 20)) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 1)) for i in range(1, 60)], "doc_id long, toxic int")
    seen, real = [], toxicity.label_model
    toxicity.label_model = lambda x, prior: seen.append(len(x)) or real(x, prior)
    try:
        toxicity.learn(docs, labels, sample=30)
        toxicity.learn(docs, labels)
    finally:
        toxicity.label_model = real
    assert seen[0] <= 30 and 50 < seen[1] <= 50 + 58


def test_label_model_finds_accurate_voters():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.15
    good = rng.random((4000, 5)) < np.where(y[:, None], 0.5, 0.003)
    echo = good[:, :1] & (rng.random((4000, 3)) < 0.95)
    poor = rng.random((4000, 1)) < np.where(y[:, None], 0.03, 0.03)
    q, accuracy, parents = toxicity.label_model(np.concatenate((good, echo, poor), axis=1).astype(np.float32), 0.15)
    assert ((q > 0.5) == y)[good.any(axis=1)].mean() > 0.85  # a single vote is right two times of three
    assert accuracy[:5].min() > 0.8 and accuracy[8] < accuracy[:5].min()
    assert (parents[5:8] >= 0).all() or (parents[0] >= 5)  # the echoes hang together


def labelled(spark, n=900):
    rows, marks = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = prose(i, 60)
        if toxic:
            w = text.split()
            for k, bad in enumerate(("Vilely", "gruntmo%d" % (i % 5), "scumble")[: 1 + i // 6 % 3]):
                w[7 + 11 * k] = bad
            text = " ".join(w)
        rows.append((i, text))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark)
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 100 and sum(r["predicted"] == r["toxic"] for r in out) / len(out) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark, 400)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_toxicity_of_odd_rows(spark, odd_documents, no_documents):
    docs, labels = labelled(spark, 300)
    more = labels.union(spark.createDataFrame([(None, 1), (5, None), (5, 1), (5, 1)], labels.schema)).selectExpr("*", "1 as text")
    out = toxicity.toxicity(docs.union(odd_documents.select("doc_id", "text")), more).collect()
    assert len(out) == 300 + odd_documents.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.toxicity(no_documents, labels).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(odd_documents, labels.limit(0)).collect()} == {0}


def test_pipeline(spark, small):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "mixing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in cp.STAGES:
        before, docs = docs, stage(spark, docs, small)
        if name != "mixing":
            assert docs.columns == before.columns
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "line_dedup":
            assert docs.count() == before.count()
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    want = sorted(map(str, docs.select("doc_id", "copy").collect()))
    assert sorted(map(str, cp.run(spark, small).select("doc_id", "copy").collect())) == want


def test_pipeline_of_odd_rows(spark, odd_documents, small):
    import corpus_pipeline as cp

    docs = odd_documents
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, small)
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} <= {None, 1, 2, 3, 4, 5, 6, 7, 9, -4}


def test_pipeline_decides_by_row(spark, tmp_path):
    """Rows without a doc_id, and rows that share one, are judged each for itself."""
    import corpus_pipeline as cp

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], schema)
    kept = lambda docs: sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    docs, labels = labelled(spark, 300)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bad = " ".join(["Vilely", "scumble", *prose(900, 40).split(), "Vilely", "scumble"])
    odd = [(i, t) for i in (None, 1) for t in (prose(901, 40), bad)]
    got = kept(cp.toxicity_stage(spark, table([*docs.collect(), *odd]), str(tmp_path)))
    assert {(i, t) for i, t in odd if t != bad} <= set(got) and not any(t == bad for _, t in got) and len(got) > 200

    spark.createDataFrame([(1, prose(77, 60))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = [(i, t) for i in (None, 1) for t in (prose(5, 40), prose(77, 60) + " more", prose(6, 40), None)]
    want = sorted([(i, t) for i, t in odd if not (t or "").endswith("more")], key=str)
    assert kept(cp.decontaminate_stage(spark, table(odd), str(tmp_path))) == want

    a, b, c = (prose(i, 60) for i in (1, 2, 3))
    rows = [(None, a), (6, a), (6, b), (5, a), (None, c), (None, c), (6, None), (None, "")]
    assert kept(cp.near_dedup_stage(spark, table(rows), "")) == sorted([(5, a), (6, b), (None, c), (6, None), (None, "")], key=str)

    rows = table([((None, 1)[i % 2], prose(i, 30)) for i in range(90)])
    out = cp.mixing_stage(spark, rows, "").collect()
    drawn = cp.mixing.mix(rows).selectExpr("sum(copies)").first()[0]
    assert len(out) == drawn and {r["text"] for r in out} == {r["text"] for r in rows.collect()}
    assert all(r["copies"] in (1, 2) for r in out) and sum(r["copies"] == 2 for r in out) < len(out)


def test_line_dedup_stage(spark):
    """Lines that ten sources share stay once; n_chars follows, rows and columns stay."""
    import corpus_pipeline as cp

    rows = [(i, f"own line {i}\nShared footer" + ("\nrare" if i < 9 else ""), "en", f"s{i % 11}", 7) for i in range(22)] + [(None, None, None, None, None), (30, "Shared footer", "en", None, 13)]
    out = {r["doc_id"]: r for r in cp.line_dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").collect()}
    assert len(out) == 24 and set(out[0].asDict()) == set(cp.COLUMNS) and out[0]["text"] == rows[0][1] and out[0]["n_chars"] == 7
    assert all(out[i]["text"] == f"own line {i}" + ("\nrare" if i < 9 else "") and out[i]["n_chars"] == len(out[i]["text"]) for i in range(1, 22))
    assert out[None]["text"] is None and out[30]["text"] == "" and out[30]["n_chars"] == 0
