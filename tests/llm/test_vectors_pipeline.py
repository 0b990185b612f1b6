"""Vantage-point trees against brute force; the pipeline's stages."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from orderlake.llm import minhash, queries, vptree
from tools.compare import digest

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, vec array<double>"


def _brute(rows, ids, k):
    out = []
    for q in ids:
        v = dict(rows)[q]
        near = sorted((float(np.sqrt(((np.array(u) - np.array(v)) ** 2).sum())), i) for i, u in rows
                      if i != q and len(u) == len(v))[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return out


def _search(spark, rows, ids, **kw):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    out = vptree.nearest(df, df.filter(F.col("vec_id").isin(ids)).withColumnRenamed("vec_id", "query_id"), **kw)
    return sorted(map(tuple, out.collect()))


def test_exact_search_with_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(-2, 3, 4).astype(float).tolist()) for k in range(700)]
    rows = [(k, v if any(v) else [1.0] * 4) for k, v in rows] + [(1000 + k, [5.0] * 4) for k in range(300)]
    ids = [0, 7, 100, 650, 1003]
    got, want = _search(spark, rows, ids, shard_rows=200), _brute(rows, ids, 10)
    assert [x[:3] for x in got] == [x[:3] for x in want] and np.allclose([x[3] for x in got], [x[3] for x in want])


def test_relaxed_search_recall(spark):
    rng = np.random.default_rng(2)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(3000, 8)))]
    ids = list(range(0, 3000, 100))
    want = {(q, i) for q, _, i, _ in _brute(rows, ids, 10)}
    got = {(q, i) for q, _, i, _ in _search(spark, rows, ids, shard_rows=1000, factor=1.3)}
    assert len(got & want) / len(want) >= 0.9


def test_factor_prunes():
    rng = np.random.default_rng(3)
    tree = vptree.Tree(rng.normal(size=(4000, 4)), np.arange(4000))
    seen = []
    inner = vptree.distances
    try:
        for factor in (1.0, 3.0):
            count = [0]
            vptree.distances = lambda p, q: count.__setitem__(0, count[0] + np.broadcast(p, q).size) or inner(p, q)
            tree.search(rng.normal(size=(1, 4)), np.array([-1]), 10, factor)
            seen.append(count[0])
    finally:
        vptree.distances = inner
    assert seen[1] < seen[0] < 4000 * 4


def test_unusable_vectors_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [2.0, 0.0]), (9, [3.0, 0.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 1.0])]
    assert _search(spark, rows, [1, 2, 4, 5, 9]) == [(1, 1, 8, 1.0)]
    assert _search(spark, [], [1]) == []


def test_rows_that_share_an_id_are_neighbours_each(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 2.0]), (2, [0.0, 9.0]), (2, [0.0, 2.0]), (3, [0.0, 5.0]), (3, [0.0, 30.0])]
    got = _search(spark, rows, [1, 3], k=4, shard_rows=2)
    assert got == [(1, 1, 2, 1.0), (1, 2, 2, 1.0), (1, 3, 3, 4.0), (1, 4, 2, 8.0),
                   (3, 1, 2, 3.0), (3, 2, 2, 3.0), (3, 3, 1, 4.0), (3, 4, 2, 4.0)]


def _clusters(seed, n, dim, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dim)) * 10
    return middles[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * spread


def test_router_bounds_hold_and_leave_out_leaves():
    rows, queries = _clusters(1, 3000, 5), _clusters(1, 40, 5)
    router = vptree.Router(rows[:256], 4)
    leaf, path = router.route(rows)
    leaves = np.unique(leaf)
    low, high = (np.array([f(path[leaf == x], axis=0) for x in leaves]) for f in (np.min, np.max))
    gap, slack = router.gaps(queries, leaves, low, high)
    least = np.array([[vptree.distances(rows[leaf == x], q).min() for x in leaves] for q in queries])
    assert (gap <= least + slack).all() and np.bincount(leaf).max() < 1500
    assert (gap > 1).mean() > 0.5                    # most leaves are left out for a limit of 1


def test_known_bounds_rebuild_the_tree():
    rows, ids = _clusters(2, 1000, 3), np.arange(1000)
    tree = vptree.Tree(rows, ids)
    again = vptree.Tree(tree.vectors[tree.order], tree.ids[tree.order], tree.bounds())
    assert again.nodes == tree.nodes
    for a, b in zip(tree.search(rows[:9], ids[:9], 4, 1.0), again.search(rows[:9], ids[:9], 4, 1.0), strict=True):
        assert (a == b).all()
    far = tree.search(rows[:9], ids[:9], 4, 1.0, np.full(9, 1e-9))[0]
    assert (far[np.isfinite(far)] <= 1).all()


def test_shards_by_router_with_hot_copies_and_several_dimensions(spark, monkeypatch):
    monkeypatch.setattr(vptree, "GROUP_QUERIES", 3)
    rows = [(k, v.tolist()) for k, v in enumerate(_clusters(3, 900, 4))]
    rows += [(2000 + k, rows[5][1]) for k in range(450)] + [(5000 + k, [float(k), 1e8]) for k in range(150)]
    rows += [(7000, [1.0, 2.0, 3.0])]
    ids = [0, 5, 17, 444, 2003, 2449, 5000, 5149, 7000]
    got, want = _search(spark, rows, ids, shard_rows=60), _brute(rows, ids, 10)
    assert [x[:3] for x in got] == [x[:3] for x in want] and np.allclose([x[3] for x in got], [x[3] for x in want])


def test_search_ignores_clashing_columns(spark):
    cols = {c: F.lit("x") for c in ("_dim", "_row", "_leaf", "_path", "score", "rank", "_q", "_sub")}
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(_clusters(4, 90, 3))], VECTORS)
    ask = df.filter("vec_id % 30 = 0").withColumnRenamed("vec_id", "query_id")
    plain = vptree.nearest(df, ask, k=3, shard_rows=20).collect()
    odd = vptree.nearest(df.withColumns(cols).withColumn("query_id", F.lit(1)), ask.withColumns(cols), k=3, shard_rows=20)
    assert odd.columns == ["query_id", "rank", "vec_id", "score"] and sorted(odd.collect()) == sorted(plain)


def test_nearest_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.sql(queries.ORACLES["op5_vantage_point_trees"])
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    got = [r.asDict() for r in queries.op5_vantage_point_trees(spark, SF).collect()]
    assert digest(got, sorted(got[0]))[0] == digest(want, sorted(rel.columns))[0]


def test_pipeline_stages(spark):
    """Each stage on its own input against a plain version of its rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        assert out.columns == first.columns
        docs = spark.createDataFrame(out.collect(), first.schema).repartition(4)
        kept = {r.doc_id for r in docs.collect()}
        if name == "language":
            assert len(kept) > 0.95 * len(before)
        elif name == "exact_dedup":
            groups = {}
            for i, t in before.items():
                groups.setdefault("".join(c for c in t if c not in " \t\n\x0b\x0c\r"), []).append((-len(t), i))
            assert kept == {min(g)[1] for g in groups.values()}
        else:
            sets = {i: minhash.text_shingles(t, 5) for i, t in before.items()}
            for i in before.keys() - kept:          # what goes has a link to something smaller
                assert any(100 * len(sets[i] & s) >= 80 * len(sets[i] | s) for j, s in sets.items() if j != i and s)
            left = sorted(kept)
            for n, i in enumerate(left):
                for j in left[n + 1:]:
                    a, b = sets[i], sets[j]
                    if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
                        assert 100 * len(a & b) < 80 * len(a | b)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept


def test_pipeline_on_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    say = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40))
    rows = [(k, say(), "xa", "s", 9, True) for k in range(30)]
    rows += [(50, None, None, None, None, None), (51, "", "xa", "s", 0, False), (None, say(), "xa", "s", 1, True), rows[0],
             (60, "alpha beta " * 60_000, "xa", "s", 1, True)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({(r.doc_id, r.piece) for r in out}) == len(out) and {r.doc_id for r in out} >= {1, 60, None}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("name", sorted([*queries.QUERIES, "pipeline"]))
def test_registered(name):
    assert name in E.queries()
    assert name not in E.oracle_sql() or name in queries.ORACLES
