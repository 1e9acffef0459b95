"""Resampling, url filter and clustering: SQL on the tables, brute force and odd rows on small ones."""

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from linecurate.llm import clustering, registry, resampling, url_filter

NEW = ("op11_resampling", "op12_url_filter", "op13_clustering")


@pytest.mark.parametrize("name", NEW)
def test_same_as_sql(name, same_as_sql):
    same_as_sql(registry.QUERIES[name], registry.ORACLE_SQL[name])


@pytest.mark.parametrize("longest", [1, 2, 5])
def test_runs_of_words(longest):
    text = "Été-2 the  the QUICK\x00b. 你好 x" * 3
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    want = sorted(crc32(" ".join(words[i : i + n]).encode()) % 97 for n in range(1, longest + 1) for i in range(len(words) - n + 1))
    parts = list(resampling.bucket_runs(low.encode(), longest, 97))
    assert sorted(int(x) for ids, _ in parts for x in ids) == want and sum(n for _, n in parts) == len(words)
    assert sum(len(ids) for ids, _ in resampling.bucket_runs(b"", longest, 97)) == 0


def brute_resample(docs, target, longest, buckets, percent, least):
    def runs(text):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return words, [crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for count, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in runs(text)[1]:
                count[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for d, text in docs:
        words, own = runs(text)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=repr)


def test_resampling_of_odd_rows(spark, odd_documents, no_documents):
    target = spark.createDataFrame([(1, "birch elm oak"), (2, None), (3, "")], "item_id int, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    for longest, percent in ((1, 100), (3, 50)):
        got = resampling.resample(odd_documents, target, longest=longest, buckets=500, percent=percent, least_words=1).collect()
        assert sorted(map(tuple, got), key=repr) == brute_resample(docs, ["birch elm oak", None, ""], longest, 500, percent, 1)
    assert resampling.resample(no_documents, target).count() == 0
    assert resampling.resample(odd_documents, target.limit(0)).count() == len(docs)


def test_chunks_add_up(monkeypatch):
    raw = b"a bc def " * 500
    whole = np.concatenate([ids for ids, _ in resampling.bucket_runs(raw, 3, 1000)])
    monkeypatch.setattr(resampling, "CHUNK", 7)
    parts = list(resampling.bucket_runs(raw, 3, 1000))
    assert len(parts) > 100 and sum(n for _, n in parts) == 1500 and (np.concatenate([ids for ids, _ in parts]) == whole).all()


def verdicts(spark, urls, labels=(), rules=url_filter.RULES):
    pages = spark.createDataFrame([(i, u, "html", "x", "y") for i, u in enumerate(urls)], "page_id long, url string, html string, token string, rule string")
    known = spark.createDataFrame(list(labels), "doc_id long, quality int, host string") if labels else spark.createDataFrame([], "doc_id long, quality int")
    rows = url_filter.judge(pages, known, rules).orderBy("page_id").collect()
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


def test_given_rules(spark):
    urls = ["http://A.Example.COM/en/1?x#y", "https://www.example.com/en/1", "https://www.example.com/fr", "http://x.net/es/", "http://x.net/en/", "http://net/fr/#a", "http://com", "http://com/", None, "", "x/y", "a://b?c://d/", "http://badexample.com/en/", "ftp://u:p@h.org:80/en/"]
    assert verdicts(spark, urls) == [
        ("a.example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("www.example.com", "/fr", "com/", "allow"), ("x.net", "/es/", "net/es/", "block"),
        ("x.net", "/en/", None, "allow"), ("net", "/fr/", "net/fr/", "block"), ("com", "", None, "allow"), ("com", "/", "com/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("b", "", None, "allow"), ("badexample.com", "/en/", "com/", "allow"), ("u:p@h.org:80", "/en/", None, "allow"),
    ]
    assert verdicts(spark, urls[:1], rules=()) == [("a.example.com", "/en/1", None, "allow")]
    assert verdicts(spark, ["http://a.b.c/xy/z"], rules=(("c/xy/z", "allow"), ("b.c/xy/", "block"), ("b.c/xyz", "block"))) == [("a.b.c", "/xy/z", "b.c/xy/", "block")]


def test_mined_rules(spark):
    good = [f"http://site{i}.org/news/story-{i % 7}.html" for i in range(200)] + [f"http://site{i}.org/casino/history" for i in range(30)]
    bad = [f"http://cheap-pills{i % 3}.org/buy/{i}" for i in range(30)] + [f"http://h{i}.org/casino/bonus/{i}" for i in range(20)]
    new = ["http://cheap-pills9.org/buy/x", "http://new.org/bonus/casino", "http://new.org/casino/history", "http://cheap-pills1.com/buy/", "http://new.org/news/", "http://new.org/" + "a/" * 50_000]
    labels = [(i, 1, "h") for i in range(len(good))] + [(len(good) + i, 0, "h") for i in range(len(bad))] + [(10**6, 0, "h"), (None, 0, "h"), (0, None, "h")]
    got = verdicts(spark, good + bad + new, labels)
    assert {v for *_, v in got[: len(good)]} == {"allow"} and {v for *_, v in got[len(good) : len(good) + len(bad)]} == {"block"}
    assert [v for *_, v in got[-6:]] == ["block", "block", "allow", "allow", "allow", "allow"]


def test_long_common_urls_make_few_items(spark):
    long = "/".join(f"part{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    urls = [f"http://spam.org/{long}/{i}" for i in range(50)] + [f"http://fine{i}.org/a" for i in range(30)]
    got = verdicts(spark, urls, [(i, int(i >= 50), "h") for i in range(80)])
    assert [v for *_, v in got] == ["block"] * 50 + ["allow"] * 30


def test_urls_of_odd_tables(spark):
    pages = spark.createDataFrame([(None, "http://a.net/es/"), (None, "http://a.net/es/"), (1, None)], "page_id long, url string")
    labels = spark.createDataFrame([(None, 0), (1, 0)], "doc_id long, quality int")
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in url_filter.judge(pages, labels).collect()) == [(0, "block"), (0, "block"), (1, "allow")]
    assert url_filter.judge(pages.limit(0), labels).count() == 0


def lloyd(rows, k, rounds, scale=1024, seed=3):
    """rows of (id, vector); every distance of every round, in Python's integers."""
    vectors = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    first = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [[math.floor(scale * x) for x in v] for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in vectors]
        for j in range(len(centroids)):
            mine = [v for (_, v), o in zip(vectors, own) if o == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted(((i, near(v)[1], min(near(v)[0], 2**63 - 1)) for i, v in vectors), key=repr), centroids


@pytest.mark.parametrize("k, size, spread", [(8, 1.0, 9), (3, 0.01, 2), (12, 1e12, 9), (5, 300.0, 9)])
def test_clusters_are_those_of_full_scans(spark, k, size, spread):
    draw = random.Random(k)
    # few values a component, so that distances tie; repeated ids and rows
    rows = [(i // 2, [size * draw.randrange(-spread, spread) / 4 + i % 5 for _ in range(4)]) for i in range(400)] + [(None, [0.0] * 4)] * 3
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, own string, cluster int").repartition(3)
    found, centroids = clustering.clusters(df, k=k, rounds=6, dimensions=4)
    want, final = lloyd(rows, k, 6)
    assert centroids == final
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_bounds_decide_without_scans():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (16, 8))
    vectors = centres[draw.integers(0, 16, 3000)] + draw.integers(-900, 900, (3000, 8))
    centroids = centres + draw.integers(-300, 300, centres.shape)
    b = clustering.Bounds.fresh(vectors, centroids, 4)
    total = 0
    for _ in range(12):
        after = np.array([vectors[b.own == c].mean(axis=0).astype(np.int64) if (b.own == c).any() else centroids[c] for c in range(16)])
        moved = np.sqrt(((after - centroids) ** 2).sum(axis=1)) * (1 + 1e-15)
        centroids = b.centroids = after
        b.scanned = 0
        b.move(moved)
        total += b.scanned
        full = ((vectors[:, None] - after) ** 2).sum(axis=2)
        assert (b.own == full.argmin(axis=1)).all()
        assert (b.upper**2 >= full.min(axis=1)).all()
        assert (b.low[:, :4] ** 2 * (b.low[:, :4] > 0) <= np.take_along_axis(full, b.near.astype(np.int64), axis=1)).all()
    assert total < 0.3 * 12 * 16 * len(vectors)


def test_clusters_of_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [1.0, float("nan")]), (4, [float("inf"), 0.0]), (5, [None, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [0.5, -0.5]), (7, [0.5, -0.5]), (8, [1e20, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in clustering.summed(*clustering.clusters(df, k=2, dimensions=2)).select("vec_id", "cluster_inertia", "inertia").collect())
    assert [g[0] for g in got] == [7, 7, 8] and len(clustering.clusters(df, k=8, dimensions=2)[1]) == 3
    assert clustering.summed(*clustering.clusters(df.limit(0), dimensions=2)).count() == 0
