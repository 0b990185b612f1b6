"""URL filter and WARC bundles."""

import base64
import hashlib
import random
import struct
import zlib

import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

from orderlake.llm import queries, urlfilter, warc
from orderlake.llm.common import scratch

PAGES = "page_id long, url string, html string"


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:stop], rest[stop:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def _rule(host, path):
    fits = [(len(t), t, v) for v, t in urlfilter.RULES for h, p in [(t[:t.index("/")], t[t.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x", "HTTPS://example.net/en?x", "http://example.net/en/",
        "http://x.net", "http://x.net/", "http://xnet/", "http://a.example.com/de/1?y#z", "http://example.com/de", "x://org/fr/ü",
        "http://É.org/fr/A", "a://b://c.net/d", "http://h?://x.net/", "http://h#/a", "http://u:p@h.net:80/p?q", "http://a\nb.net/\nc?d"]


def test_rules_and_split(spark):
    rows = [(k, u, None) for k, u in enumerate(URLS)] + [(3, URLS[3], None)]
    out = urlfilter.judge_urls(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = _split(URLS[r.page_id])
        rule, verdict = _rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == (verdict or ("allow" if r.score >= r.threshold else "block"))


def test_model_separates_and_calibrates(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(12))        # noqa: E731
    rows = []
    for k in range(600):
        good = k % 2 == 0
        name = word("aeiou" if good else "xqzkw")
        host = rng.choice(["a.org/fr/", "h.test/"]) if good else rng.choice(["b.net/", "h.test/"])
        rows.append((k, f"http://{host}{name}", None))
    out = urlfilter.judge_urls(spark.createDataFrame(rows, PAGES)).collect()
    free = [r for r in out if r.rule is None]
    assert len(free) > 200 and sum((r.verdict == "allow") == (r.page_id % 2 == 0) for r in free) / len(free) > 0.97


def test_ratio_matches_a_plain_model():
    """The vectorised ratio is the smoothed recursion, term by term."""
    import math

    import numpy as np
    texts = ["ab.net/x", "é/ü", "", "zz" * 40]
    counts = np.zeros((2, urlfilter.TABLES, 1 << urlfilter.BITS), np.float32)
    for c in (0, 1):
        grams, contexts, _ = urlfilter._hashed(texts[c:c + 2])
        for k in range(urlfilter.ORDER + 1):
            np.add.at(counts[c, k], grams[k], 1)
            if k:
                np.add.at(counts[c, urlfilter.ORDER + k], contexts[k], 1)
    got = urlfilter.ratio(texts, counts)
    for t, value in zip(texts, got):
        grams, contexts, lengths = urlfilter._hashed([t])
        total = 0.0
        for i in range(int(lengths[0])):
            for c, sign in ((0, -1), (1, 1)):
                p = (counts[c, 0][grams[0][i]] + urlfilter.PRIOR / 256) / (counts[c, 0].sum() + urlfilter.PRIOR)
                for k in range(1, urlfilter.ORDER + 1):
                    p = (counts[c, k][grams[k][i]] + urlfilter.PRIOR * p) / (
                        counts[c, urlfilter.ORDER + k][contexts[k][i]] + urlfilter.PRIOR)
                total += sign * math.log(p)
        assert value == pytest.approx(total / (len(t.encode()) + 1), rel=1e-4, abs=1e-5)


def test_scores_are_exact_beyond_a_fixed_table(spark):
    """More n-grams of an order than any 2**16 slots hold apart, against counts in dictionaries."""
    import math
    from collections import Counter

    rng = random.Random(5)
    rows = []
    for k in range(6000):
        name = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789-_~%") for _ in range(40))
        rows.append((k, f"http://{['b.net', 'a.org/fr', 'h.test'][k % 3]}/{name}", None))
    out = {r.page_id: r for r in urlfilter.judge_urls(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert len(out) == len(rows)
    grams, contexts = Counter(), Counter()
    spell = lambda r: [1] * 4 + [*(r.host + r.path).encode(), 0]                    # noqa: E731
    for r in out.values():
        if r.rule and zlib.crc32(str(r.page_id).encode()) % urlfilter.CALIBRATE:
            b = spell(r)
            for at in range(4, len(b)):
                for n in range(5):
                    grams[r.verdict, tuple(b[at - n:at + 1])] += 1
                    contexts[r.verdict, n, tuple(b[at - n:at])] += 1
    assert sum(len(g) == 5 and c == "block" for c, g in grams) > 60_000
    for k in range(2, 6000, 97):
        b, total = spell(out[k]), 0.0
        for at in range(4, len(b)):
            for c, sign in (("block", -1), ("allow", 1)):
                p = 1 / 256
                for n in range(5):
                    p = (grams[c, tuple(b[at - n:at + 1])] + urlfilter.PRIOR * p) / (
                        contexts[c, n, tuple(b[at - n:at])] + urlfilter.PRIOR)
                total += sign * math.log(p)
        assert out[k].score == pytest.approx(total / (len(b) - 4), abs=1e-8)


def test_url_empty_and_query(spark):
    assert urlfilter.judge_urls(spark.createDataFrame([], PAGES)).count() == 0
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = queries.op2_url_lm_ratio(spark, sf).collect()
    assert len(out) == len(pages)
    for r in out:
        assert (r.host, r.path) == _split(pages[r.page_id]) and r.rule == _rule(r.host, r.path)[0]


def _expected(rows, least):
    best = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None:
            best[p] = max(best.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        head = best.get(p)
        other = len(p) >= least and head is not None and head != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "revisit" if other else "response", head if other else None))
    return sorted(out, key=str)


PAGE_ROWS = [(1, "http://a/", "x"), (2, "http://b c/\r\nWARC-Type: revisit", "x"), (3, None, None), (4, "u", ""),
             (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (6, "u", "long" * 200_000), (7, "u", "x"), (7, "u", "x"), (None, "u", "q"),
             (None, "u", "x"), (8, "u", "long" * 200_000)] + [(100 + k, "http://h/", "same") for k in range(60)]


@pytest.mark.parametrize("least", [0, 3])
def test_warc_round_trip(spark, least):
    out = warc.archive_round_trip(spark.createDataFrame(PAGE_ROWS, PAGES).repartition(4), min_bytes=least)
    assert sorted(map(tuple, out.collect()), key=str) == _expected(PAGE_ROWS, least)


def test_warc_seek(spark):
    folder = scratch(spark, "warc-test")
    index = warc.write_archives(spark.createDataFrame(PAGE_ROWS, PAGES).repartition(2), folder, frame_bytes=2000)
    assert index.count() == len(PAGE_ROWS)
    for r in index.filter("page_id in (5, 6, 100, 159)").collect():
        fs, path = pafs.FileSystem.from_uri(r.path)
        with fs.open_input_file(path) as f:
            table = warc.seek_table(f)
            data = f.read_at(f.size(), 0)
        offset, size = table[r.frame]
        frame = warc.read_frame(r.path, offset, size)
        head, block, end = warc.parse(frame, r.record_offset)
        assert head["WARC-Record-ID"] == f"<urn:page:{r.page_id}>" and end - r.record_offset == r.record_bytes
        # a plain Zstandard reader skips the footer and reads all frames in a row
        whole = b"".join(zstandard.ZstdDecompressor().decompress(data[a:a + n]) for a, n in table)
        assert frame in whole
        assert struct.unpack("<I", data[sum(n for _, n in table):][:4])[0] == warc.SKIPPABLE_MAGIC


def test_warc_empty_and_clashing(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0
    df = spark.createDataFrame([(1, "u", "h", "d", b"p")], PAGES + ", digest string, payload binary")
    assert warc.archive_round_trip(df.withColumn("size", F.lit(3))).count() == 1
