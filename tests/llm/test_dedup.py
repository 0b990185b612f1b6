"""Exact and near dedup against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from orderlake.llm import components, exact_dedup, minhash


def _exact(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i, k))
    out = []
    for body, group in groups.items():
        best = min(group)
        out += [(i, best[1], len(group), hashlib.sha256(body.encode()).hexdigest()) for _, i, _ in group]
    return sorted(out)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n\t"), (7, "é x"), (8, "éx"), (9, "a\x0bb\x0c"),
        (10, "unique"), (11, "ab")] + [(100 + k, "copy of " * 3) for k in range(200)] + [(500, "z " * 30_000)]


def _result(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


def test_exact_dedup_brute_force(make_docs):
    out = exact_dedup.exact_dedup(make_docs(ROWS, 5))
    assert _result(out) == _exact(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out.collect())


def test_exact_dedup_separates_hash_collisions(make_docs):
    weak = lambda text: F.unhex(F.hex(F.length(text) % 3))                        # noqa: E731
    rng = random.Random(1)
    rows = ROWS + [(1000 + k, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 4)))) for k in range(120)]
    assert _result(exact_dedup.exact_dedup(make_docs(rows, 4), hash128=weak)) == _exact(rows)


def test_exact_dedup_salts_large_groups(make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 16)
    assert _result(exact_dedup.exact_dedup(make_docs(ROWS, 5))) == _exact(ROWS)


def test_exact_dedup_repeated_rows_keep_one(spark, make_docs):
    docs = make_docs([(1, "x"), (1, "x"), (1, "y"), (2, "x "), (None, "q"), (None, "q")])
    out = exact_dedup.exact_dedup(docs)
    assert out.filter("kept").count() == 3 and out.count() == 6
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in left.collect()) == [(-1, "q"), (1, "y"), (2, "x ")]
    same = make_docs([(1, "x"), (1, "x"), (2, "y")])
    assert sorted((r.doc_id, r.text) for r in exact_dedup.drop_copies(same).collect()) == [(1, "x"), (2, "y")]


def test_exact_dedup_empty_and_clashing_columns(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "a", "k", True), (2, "a", "l", False)],
                               "doc_id long, text string, _h string, kept boolean")
    assert exact_dedup.exact_dedup(df).filter("kept").count() == 1
    assert exact_dedup.drop_copies(df).columns == df.columns
    clash = df.withColumnsRenamed({"_h": "_own", "kept": "_id"}).withColumns({"_gone": F.lit(1), "c0": F.lit(2)})
    assert exact_dedup.drop_copies(clash).columns == clash.columns and exact_dedup.drop_copies(clash).count() == 1
    assert minhash.drop_near_copies(clash).columns == clash.columns and minhash.drop_near_copies(clash).count() == 1


def _near(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def _families(seed, families=12, size=9):
    """Edited copies at, above and below the threshold, in chains."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))              # noqa: E731
    rows = []
    for f in range(families):
        base = [word() for _ in range(rng.choice([2, 3, 5, 8, 40, 90]))]
        for k in range(size):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 15))):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.5:
                base = w                              # a chain: ends need not be alike
            rows.append((rng.randrange(10**6) * 1000 + f * 20 + k, " ".join(w).title() if rng.random() < .3 else " ".join(w)))
    return rows


def test_near_duplicates_brute_force(make_docs):
    for words, percent, seed in ((3, 85, 1), (5, 80, 2)):
        rows = _families(seed) + [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (6, "one two"), (7, "É x y z"),
                                  (8, "é x y z"), (9, "w " * 3000), (10, "v" * 5000)]
        out = minhash.near_duplicates(make_docs(rows, 4), words, percent)
        assert sorted(map(tuple, out.collect())) == _near(rows, words, percent)


def test_near_duplicates_large_group_in_cells(make_docs, monkeypatch):
    """Buckets whose star leaves several components go through the cells."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = _families(7, families=4, size=40)
    out = minhash.near_duplicates(make_docs(rows, 4), 3, 85)
    assert sorted(map(tuple, out.collect())) == _near(rows, 3, 85)


def test_cells_join_components_once(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(minhash, "COLUMNS", 3)
    texts = ["a b c d", "a b c d e", "x y z", "x y z w", "a b c d", "q"]
    cell = pd.DataFrame({"lo": 0, "hi": 1, "block": [0, 1, 0, 1, 1, 0], "node": range(6), "label": range(6), "text": texts})
    cross = minhash._cells(3, 50)
    assert cross(cell).to_numpy().tolist() == [[0, 1], [0, 4], [2, 3]]
    assert len(cross(cell.assign(label=[0, 0, 2, 2, 0, 5]))) == 0
    within = cell.assign(hi=0, block=0)
    assert cross(within).to_numpy().tolist() == [[0, 1], [0, 4], [2, 3]]


def test_shared_counts():
    import numpy as np
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (minhash._shared(sets, None) == want)[~np.eye(30, dtype=bool)].all()
    assert (minhash._shared(sets[:10], sets[10:]) == want[:10, 10:]).all()


def test_near_duplicates_empty_and_repeated(spark, make_docs):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = make_docs([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (3, "a b c e f")])
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, 85).collect())
    assert got == [(0, 1, False), (1, 1, True), (1, 1, True), (3, 3, True)]
    assert minhash.drop_near_copies(docs).columns == docs.columns


def test_word_hashes_over_slices(monkeypatch):
    import numpy as np
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 200]))) for _ in range(400)]
    data = " \n".join(words).encode()
    whole, _ = minhash.word_hashes(data)
    monkeypatch.setattr(minhash, "SLICE", 64)
    cut, _ = minhash.word_hashes(data)
    assert (whole == cut).all() and len(np.unique(whole)) == len(set(words))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, 5), (7000, 6999)]
    out = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(out[k] == 0 for k in range(61)) and all(out[1000 + k] == 1000 for k in range(200)) and out[7000] == 6999
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_words_that_collide_in_a_power_of_two(make_docs):
    """Thue-Morse words have equal polynomials modulo 2**64, whatever the odd multiplier."""
    def word(n, swap):
        return "".join("ba"[bin(k).count("1") % 2 ^ swap] for k in range(1 << n))
    assert len({int(minhash.word_hashes(word(11, k).encode())[0][0]) for k in (0, 1)}) == 2
    rows = [(1, word(11, 0)), (2, word(11, 1)), (3, word(11, 0).upper()), (4, f"x {word(11, 0)} y {word(11, 1)} z")]
    out = minhash.near_duplicates(make_docs(rows), 3, 85)
    assert sorted(map(tuple, out.collect())) == _near(rows, 3, 85)
    assert sorted(r.component_id for r in out.collect()) == [1, 1, 2, 4]


def test_equal_sets_of_other_sequences_are_linked(make_docs):
    rows = [(9, "a b a b a b"), (4, "a b a b a b a b"), (7, "b a b a b"), (2, "c d")]
    out = minhash.near_duplicates(make_docs(rows), 2, 85)
    assert sorted(map(tuple, out.collect())) == _near(rows, 2, 85)


def test_rows_that_share_an_id_are_dropped_one_by_one(make_docs):
    text = "one two three four five six seven eight nine ten " * 3
    a, copy, other = text + "end", text + "END", "nothing of the kind is said in this text at all"
    kept = minhash.drop_near_copies(make_docs([(1, a), (5, copy), (5, other), (None, "x " + text[:49]), (7, a)])).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in kept) == [(0, "x " + text[:49]), (1, a), (5, other)]
