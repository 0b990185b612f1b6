"""Byte-balanced shards and length buckets against brute force."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import common, packing, sharding

EMPTY = "doc_id long, text string"


def _check(rows, texts, shards):
    """Laws of the contract; texts is the multiset of (doc_id, text)."""
    size = lambda t: len((t or "").encode()) + 8                                 # noqa: E731
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in texts)
    by = {}
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by.setdefault(r.shard, []).append(r)
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    target = sum(size(t) for _, t in texts) / shards
    largest = max(size(t) for _, t in texts)
    for s in range(shards):
        assert abs(sum(r.size for r in by.get(s, [])) - target) <= largest


def test_shards_of_skewed_sizes(make_docs):
    rng = random.Random(3)
    texts = [(k, rng.choice([None, "", "é" * rng.randint(0, 50), "copy", "x" * rng.randint(0, 900)])) for k in range(600)]
    texts += [(600 + k, "copy") for k in range(300)] + [(5, "again"), (5, "again"), (900, "z" * 20_000)]
    out = sharding.shard_documents(make_docs(texts, 7), shards=7).collect()
    _check(out, texts, 7)
    runs = [r.shard for r in out if r.text_crc32 == zlib.crc32(b"copy")]
    assert max(runs) - min(runs) + 1 == len(set(runs))        # copies are neighbours


def test_shards_are_contiguous_in_the_order(spark):
    df = spark.createDataFrame([(k, 10 + k % 7) for k in range(500)], "k long, size long").repartition(9)
    out = sharding.shard_by_bytes(df, ["k"], "size", 8).orderBy("k").collect()
    assert [r.shard for r in out] == sorted(r.shard for r in out)
    assert [r.slot for r in out] == [k for _, g in itertools.groupby(r.shard for r in out) for k in range(len(list(g)))]


def test_shards_of_empty_and_small_tables(spark, make_docs):
    assert sharding.shard_documents(spark.createDataFrame([], EMPTY)).count() == 0
    assert sharding.shard_documents(make_docs([(1, "a"), (None, None)])).count() == 2


def test_shards_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "x", 5), (2, "b", "y", 6)], "doc_id long, text string, _key string, size int")
    assert sharding.shard_documents(df, 2).columns[:2] == ["doc_id", "size"]


def test_ranked_inside_a_hot_group(spark):
    df = spark.createDataFrame([("hot" if k % 3 else f"g{k}", k, k % 5) for k in range(900)], "g string, k long, n long")
    got = common.ranked(df.repartition(6), ["k"], "t", group=["g"], sums=["n"]).filter("g = 'hot'").orderBy("k").collect()
    assert [r._row for r in got] == list(range(600))
    assert [r._before_n for r in got] == list(np.cumsum([0] + [r.n for r in got])[:-1])


def _least(lengths, counts, k):
    m, best = len(lengths), None
    for cut in itertools.combinations(range(m - 1), min(k, m) - 1):
        ends = [*cut, m - 1]
        cost = a = 0
        for e in ends:
            cost += sum(c * (lengths[e] - x) for x, c in zip(lengths[a:e + 1], counts[a:e + 1]))
            a = e + 1
        best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 10)))
    counts = [rng.randint(1, 30) for _ in lengths]
    for k in (1, 2, 3, 5):
        bounds = packing.bucket_bounds(np.array(lengths), np.array(counts), k)
        assert len(bounds) <= k and bounds[-1] == lengths[-1]
        cost = sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))
        assert cost == _least(lengths, counts, k)


def test_pack_loses_nothing(spark, make_docs):
    rng = random.Random(5)
    texts = [(k, rng.choice([None, "", "é" * rng.randint(0, 90), "w" * rng.randint(0, 150)])) for k in range(400)]
    texts += [(7, "twice"), (7, "twice"), (None, "null id"), (1000, "y" * 1234)]
    rows = packing.pack(make_docs(texts, 5), buckets=4, max_length=100, batch_tokens=300).collect()
    total = {}
    for r in rows:
        assert 1 <= r.n_tokens <= r.bound <= 100 and r.padding == r.bound - r.n_tokens and r.start == 100 * r.piece
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    want = {}
    for i, t in texts:
        want[i] = want.get(i, 0) + len((t or "").encode()) + 1
    assert total == want
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    last = {b: max(x for y, x in batches if y == b) for b, _ in batches}
    for (b, n), group in batches.items():
        most = max(1, 300 // group[0].bound)
        assert sorted(r.place for r in group) == list(range(len(group))) and len(group) <= most
        assert n == last[b] or len(group) == most
    lengths = sorted({r.n_tokens for r in rows})
    counts = [sum(r.n_tokens == x for r in rows) for x in lengths]
    bounds = packing.bucket_bounds(np.array(lengths), np.array(counts), 4)
    assert sum(r.padding for r in rows) == sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts))


def test_written_batches_rebuild_every_text(spark, make_docs, tmp_path):
    rng = random.Random(6)
    texts = [(k, rng.choice([None, "", "é" * rng.randint(0, 90), "w\0" * rng.randint(0, 75)])) for k in range(300)]
    texts += [(407, "twice"), (407, "twice"), (None, "null id"), (2**62 + 1, "語" * 1234), (1001, "x" * 99), (1002, "x" * 100)]
    docs = make_docs(texts, 5).withColumns({c: F.lit("clash") for c in ("piece", "bucket", "_uid", "_body", "slice", "_total")})
    opts = dict(buckets=4, max_length=100, batch_tokens=300)
    packing.write_batches(docs, f"{tmp_path}/b", **opts)
    pieces, crcs = [], []
    for r in spark.read.parquet(f"{tmp_path}/b").collect():
        ids, mask = packing.matrix(r.ids, r.n_tokens, r.bound)
        assert ids.shape == mask.shape == (len(r.doc_id), r.bound) and (ids[~mask] == packing.PAD).all()
        assert ids.size <= max(300, r.bound) and (ids[mask] < packing.PAD).all()
        for place, (i, start, n) in enumerate(zip(r.doc_id, r.start, r.n_tokens, strict=True)):
            pieces.append((i, start, ids[place, :n].tolist()))
            crcs.append((i, start, n, zlib.crc32(ids[place, :n].tobytes())))
    whole, left = [], {}
    for i, start, tokens in sorted(pieces, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        left[i] = tokens if start == 0 else left[i] + tokens
        if tokens[-1] == packing.END:
            whole.append((i, bytes(left[i][:-1])))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])           # noqa: E731
    assert sorted(whole, key=key) == sorted(((i, (t or "").encode()) for i, t in texts), key=key)
    back = packing.read_batches(spark, f"{tmp_path}/b")
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.tokens_crc32) for r in back.collect()], key=str) == sorted(crcs, key=str)
    packed = packing.pack(docs, **opts)
    same = ["doc_id", "piece", "start", "n_tokens", "bucket", "bound", "padding"]
    numbers = lambda df: sorted(map(str, df.collect()))      # noqa: E731
    assert numbers(back.select(same)) == numbers(packed.select(same))
    assert numbers(back.groupBy("bucket", "batch").count()) == numbers(packed.groupBy("bucket", "batch").count())
    assert numbers(back.select("bucket", "batch", "place")) == numbers(packed.select("bucket", "batch", "place"))


def test_pack_empty(spark):
    assert packing.batch_round_trip(spark.createDataFrame([], EMPTY)).count() == 0
    assert packing.pack(spark.createDataFrame([], EMPTY)).count() == 0


def test_query_op3_covers_all_documents(spark):
    from orderlake.llm import queries
    sf = "/root/testdata/sf0.001"
    out = queries.op3_length_buckets(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.agg(F.sum("n_tokens")).first()[0] == docs.agg(
        F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)).first()[0]


def test_query_op1_laws(spark):
    from orderlake.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    _check(queries.op1_sharding(spark, sf).collect(), [tuple(r) for r in docs], 24)
