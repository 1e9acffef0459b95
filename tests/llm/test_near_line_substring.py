"""Near duplicates, line and passage dedup, against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_texts import prose

from linecurate.llm import line_dedup, near_dedup, registry, substring_dedup
from linecurate.llm import textblocks as tb

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_sets(texts, width):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().translate(LOWER))
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def classes(ids, texts, width, hundredths):
    sets, root = shingle_sets(texts, width), {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for k, s in enumerate(sets):
        both = Counter(j for g in s for j in where[g])
        for j, n in both.items():
            if 100 * n >= hundredths * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(ids[k]), find(ids[j])))
                root[b] = a
        for g in s:
            where[g].append(k)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def test_word_hashes():
    rng = random.Random(3)
    texts = ["", " a ", "a\tb\x0bc\nA", "éé é", "x" * 3_000_000 + " y", *("".join(rng.choice("ab \n") for _ in range(50)) for _ in range(200))]
    raws = [tb.lowered(t) for t in texts]
    hashes, counts = tb.word_hashes(raws)
    words = [re.findall(rb"[^\x20\x09-\x0d]+", r) for r in raws]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, (1, 120), dtype=np.uint64)
    b = a.copy()
    b[0, :12] = rng.integers(0, 2**63, 12, dtype=np.uint64)
    x, y = near_dedup.odd_sketches(np.concatenate((a, b)))
    assert np.bitwise_count(x ^ y).sum() <= 24 and not (x ^ x).any()


def test_near_duplicates_like_brute_force(spark):
    rng = random.Random(5)
    texts = {}
    for g in range(25):
        base = prose(g, rng.choice((5, 40, 120))).split()
        for _ in range(8):
            w = base[:]
            for _ in range(rng.choice((0, 1, 2, 4, 9))):
                w[rng.randrange(len(w))] = "new%d" % rng.randrange(10**6)
            texts[len(texts) * 7 % 1009] = " ".join(w)
    ids = list(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for width, threshold in ((3, 0.85), (5, 0.8)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, width, threshold).collect()}
        assert got == classes(ids, list(texts.values()), width, round(100 * threshold))


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Buckets larger than a block give the same classes."""
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rng = random.Random(9)
    base = prose(3, 100).split()
    texts = []
    for _ in range(60):
        w = base[:]
        for _ in range(rng.randrange(8)):
            w[rng.randrange(100)] = "new%d" % rng.randrange(10**6)
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, 3, 0.85).collect()}
    assert got == classes(list(range(60)), texts, 3, 85)


def test_near_duplicates_of_chains_in_blocks(spark, monkeypatch):
    """A chain of texts, each near the next alone, so that no hub links a group."""
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    words = prose(31, 400).split()
    texts = [" ".join(words[2 * i : 2 * i + 100]) for i in range(50)]
    random.Random(1).shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, 3, 0.85).collect()}
    assert got == classes(list(range(50)), texts, 3, 85)


def test_near_duplicates_of_repeated_ids(spark):
    """All texts of a doc_id count, whichever row comes first."""
    a, b = prose(61, 100), prose(62, 100)
    rows = [(1, a), (1, b), (2, a.rsplit(" ", 2)[0]), (3, b.rsplit(" ", 2)[0]), (3, b.rsplit(" ", 2)[0]), (4, prose(63, 100)), (9, prose(63, 100)), (9, "")]
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df, 3, 0.85).collect())
        assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1), (4, 4), (9, 4), (9, 9)]


def test_op3_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = registry.QUERIES["op3_near_dedup"](spark, small).collect()
    want = classes([r["doc_id"] for r in rows], [r["text"] for r in rows], 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(spark, odd_documents, no_documents):
    out = near_dedup.near_duplicates(odd_documents).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == odd_documents.count()
    assert by[2]["n_shingles"] == by[3]["n_shingles"] == by[4]["n_shingles"] == 0 and by[2]["kept"] and by[3]["kept"]
    assert by[8]["component_id"] == 7 and not by[8]["kept"] and by[None]["kept"] and by[None]["component_id"] is None
    assert near_dedup.near_duplicates(no_documents).count() == 0


def test_op1_query(same_as_sql):
    same_as_sql(registry.QUERIES["op1_line_dedup"], registry.ORACLE_SQL["op1_line_dedup"])


def test_boilerplate(spark):
    rows = [(i, f"s{i % 6}", f"own line {i}\n  Shared footer\t\n\nrare line" if i < 3 else f"own line {i}\nShared footer\n") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(df, min_sites=5).collect()}
    assert out[0]["text"] == rows[0][2] and out[0]["lines_dropped"] == 0  # the first occurrence stays
    assert out[1]["text"] == "own line 1\n\nrare line" and out[5]["text"] == "own line 5\n"
    # null sites count as none
    assert {r["lines_dropped"] for r in line_dedup.drop_boilerplate(df.selectExpr("doc_id", "text", "cast(null as string) as source"), min_sites=5).collect()} == {0}


def test_many_sites_use_the_sketch(spark):
    """Far above the threshold the estimate decides, near it the exact count."""
    rows = [(i, f"s{i}", "everywhere\nlocal %d" % i + ("\nnearly" if i < 10 else "") + ("\nnot quite" if i < 9 else "")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    dropped = {r["doc_id"]: r["lines_dropped"] for r in line_dedup.drop_boilerplate(df, min_sites=10).collect()}
    assert dropped == {i: (i > 0) + (0 < i < 10) for i in range(400)}


def test_lines_of_odd_rows(odd_documents, no_documents):
    out = line_dedup.drop_boilerplate(odd_documents, min_sites=1).collect()
    assert len(out) == odd_documents.count() and set(odd_documents.columns) < set(out[0].asDict())
    by = {r["doc_id"]: r for r in out}
    assert by[3]["text"] is None and by[3]["lines_seen"] == 0 and by[4]["text"] == "   \n\t " and by[1]["text"] == ""  # its line comes first without a doc_id
    assert line_dedup.drop_boilerplate(no_documents).count() == 0


def passages_by_hand(docs, least=3, min_words=16, long_words=24):
    """Sentences covered by runs that came before, for each doc_id."""
    seen, gone = {}, defaultdict(set)
    for doc_id in sorted(docs):
        ss = [s.lower().split() for s in re.findall(r"\S[^.]*\.", docs[doc_id])]
        for i in range(len(ss)):
            n = 0
            for j in range(i, len(ss)):
                n += len(ss[j])
                if j - i + 1 >= least and n >= min_words or j > i and n >= long_words:
                    key = tuple(map(tuple, ss[i : j + 1]))
                    if key in seen:
                        gone[doc_id] |= set(range(i, j + 1))
                    seen.setdefault(key, (doc_id, i))
                    break
    return {d: len(g) for d, g in gone.items()}


def passages_of(rows, least=3, min_words=16, long_words=24):
    """Sentences removed from each document, by strings and one dictionary of runs."""
    seen, out = {}, {}
    for doc_id, text in sorted((r["doc_id"], r["text"] or "") for r in rows):
        ss = []
        for line in re.split("\n", text):
            now = []
            for w in re.findall(r"[^\x20\x09-\x0d]+", line):
                if now and (now[-1][-1] in ".!?" or opening(w) and not opening(now[-1])):
                    ss.append(now)
                    now = []
                now.append(w)
            ss += [now] if now else []
        gone = set()
        for i in range(len(ss)):
            for j in range(i + 1, len(ss)):
                n = sum(map(len, ss[i : j + 1]))
                if j - i + 1 >= least and n >= min_words or n >= long_words:
                    key = tuple(tuple(w.encode().translate(LOWER) for w in x) for x in ss[i : j + 1])
                    if seen.setdefault(key, (doc_id, i)) != (doc_id, i):
                        gone |= set(range(i, j + 1))
                    break
        if gone:
            out[doc_id] = len(gone)
    return out


def opening(word):
    return "A" <= word[0] <= "Z" or "\u00c0" <= word[0] <= "\u00de" and word[0] != "\u00d7"


def test_passages(spark):
    shared = prose(99, 60)
    shared = shared[: shared.rindex(".") + 1]
    docs = {i: prose(i, 80).rsplit(".", 1)[0] + "." for i in range(6)}
    for i in (1, 3, 4):
        docs[i] = docs[i][: docs[i].index(".") + 1] + " " + shared + docs[i][docs[i].index(".") + 1 :]
    out = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert {d: r["sentences_removed"] for d, r in out.items()} == passages_by_hand(docs) and set(out) == {3, 4}
    assert shared not in out[3]["text"] and out[3]["first_doc_ids"] == [1]
    assert out[3]["text"].split() == docs[3].replace(shared, "").split()


def test_passage_inside_a_sentence(spark):
    shared = prose(42, 70).rsplit(".", 1)[0] + "."
    docs = [(0, shared), (1, "some words in lower case " + shared + " and so on."), (2, prose(50, 30))]
    out = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(out) == {1} and out[1]["text"].split() == "some words in lower case and so on.".split()


def test_a_single_sentence_is_no_run(spark):
    long = "One sentence of " + "very " * 40 + "many words."
    docs = [(i, f"Lead {i} alone here. {long} Tail {i} it is {i}.") for i in range(4)]
    assert substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


def test_passages_of_repeated_ids_and_rows_without_one(spark):
    """Only the text that holds a repeat loses it; rows without a doc_id come last."""
    shared = prose(99, 60).rsplit(".", 1)[0] + "."
    own = prose(12, 60).rsplit(".", 1)[0] + "."
    docs = [(1, shared), (2, "Some lead in here. " + shared), (2, own), (None, "Another lead. " + shared), (2, own)]
    for parts in (1, 4):
        out = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)).collect()
        assert sorted(((r["doc_id"], r["text"].strip(), r["first_doc_ids"]) for r in out), key=str) == [(2, "Some lead in here.", [1]), (None, "Another lead.", [1])]


def test_line_feeds_stay(spark):
    text = "Kept one.\nGone a b c. Gone d e f.\nKept two."
    assert substring_dedup.cut_out(text, np.array([[1, 3]]))[0] == "Kept one.\nKept two."
    assert substring_dedup.cut_out(text, np.array([[2, 3]]))[0] == "Kept one.\nGone a b c. \nKept two."
    assert substring_dedup.cut_out("A b. C d.", np.array([[0, 2]]))[0] == ""


def test_passages_of_odd_rows(odd_documents, no_documents):
    out = substring_dedup.repeated_passages(odd_documents).collect()
    assert {r["doc_id"] for r in out} <= {None, 1, 6} and all(r["sentences_removed"] > 0 for r in out)
    assert substring_dedup.repeated_passages(no_documents).count() == 0


@pytest.mark.parametrize("name", ["op4_substring_dedup"])
def test_op4_query(name, spark, small):
    ids = {r["doc_id"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect()}
    rows = registry.QUERIES[name](spark, small).collect()
    assert rows and {r["doc_id"] for r in rows} <= ids and all(set(r["first_doc_ids"]) <= ids for r in rows)
    assert {r["doc_id"]: r["sentences_removed"] for r in rows} == passages_of(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
