"""Dual-tree search against a plain scan of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import dualtree as D

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def _brute(docs, items, k=50):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc, s))
        scores.sort(key=lambda x: x[:3])
        out += [(item, r + 1, x[3], x[4]) for r, x in enumerate(scores[:k])]
    return sorted(out, key=str)


def _ranked(spark, docs, items, parts=3, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    i = spark.createDataFrame(items, "item_id long, text string")
    d = d.withColumn("n", F.lit("x")).withColumn("terms", F.lit(1)).withColumn("_item", F.lit(2))
    i = i.withColumn("doc_id", F.lit("x")).withColumn("score", F.lit(1))
    return sorted(map(tuple, D.rank_documents(d, i, **kw).collect()), key=str)


def _words(rng, n, vocabulary=60):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


@pytest.mark.parametrize("seed_docs", [100, 10 ** 6])
def test_ranks_like_a_scan(spark, monkeypatch, seed_docs):
    monkeypatch.setattr(D, "BLOCK_ROWS", 150)
    rng = random.Random(1)
    docs = [(k * 3, _words(rng, rng.randint(0, 40))) for k in range(900)]
    docs += [(5000 - k, "W1, w2; w3! " + "über Über") for k in range(120)]           # ties in falling ids
    items = [(k, _words(rng, rng.randint(1, 12))) for k in range(40)] + [(100, "w1 über"), (101, "none"), (102, "")]
    assert _ranked(spark, docs, items, seed_docs=seed_docs) == _brute(docs, items)


def test_item_batches(spark, monkeypatch):
    monkeypatch.setattr(D, "ITEM_BYTES", 900)
    rng = random.Random(2)
    docs, items = [(k, _words(rng, 20)) for k in range(200)], [(k, _words(rng, 8)) for k in range(25)]
    assert _ranked(spark, docs, items, k=7) == _brute(docs, items, 7)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "--- \x00"), (None, "alpha beta"), (None, "alpha"), (4, "Alpha"), (4, "Alpha"),
            (5, "gamma " * 300_000 + "alpha"), (6, "日本語 alpha　beta")]
    items = [(1, "alpha beta gamma"), (1, "alpha"), (None, "beta 日本語"), (2, None), (3, "zeta")]
    got = _ranked(spark, docs, items)
    assert got == _brute(docs, items)
    assert _ranked(spark, [], items) == [] and _ranked(spark, docs, []) == []
    assert _ranked(spark, [(1, None)], items) == []


def test_whole_numbers_beyond_doubles():
    assert D.impacts(np.array([3]), np.array([10 ** 8]), 10 ** 12, 10 ** 13)[0] == \
        10 ** 9 * 3 // (3000 + 20 * (50 + 50 * 10 ** 20 // 10 ** 13))
    rows = [{"_item": 0, "terms": [b"a", b"b"], "weights": [2 ** 42, 3]}]
    assert D.Items(rows).kind is np.int64


def test_bounds_prune_and_hold():
    rng = np.random.default_rng(3)
    common = 1 / np.arange(1, 101)

    def rows(n, low):
        sets = [np.sort(low[k % 2] + rng.choice(100, 12, replace=False, p=common / common.sum())) for k in range(n)]
        return np.arange(0, 12 * n + 1, 12), np.concatenate(sets)
    ptr, idx = rows(600, (0, 100))
    docs = D.Tree(ptr, idx, rng.integers(1, 1000, len(idx)).astype(float), 200, 32)
    for level, (p, _, v) in enumerate(docs.levels[:-1]):
        q, _, w = docs.levels[level + 1]
        for node in range(1 << level):
            assert v[p[node]:p[node + 1]].max() == w[q[2 * node]:q[2 * node + 2]].max()
    ptr, idx = rows(20, (0, 0))                                     # items know only half of the documents
    items = D.Tree(ptr, idx, rng.integers(1, 1000, len(idx)).astype(float), 200, 4)
    best = D.Best(20, 5, np.ones(20, np.int64))
    search = D.Search(items, docs, np.arange(600), np.zeros(600, bool), best)
    assert search.scored < 20 * 600 * 0.75
