"""Day bitmaps, observed steps, chunked digests and keyed survivors against plain versions."""

import datetime as dt
import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.operators import calendar as cal
from orderlake.operators import quality
from orderlake.sources import digests
from orderlake.streaming.survivors import rocksdb, survivors


def _holes(days):
    return {min(days) + dt.timedelta(n) for n in range((max(days) - min(days)).days)} - set(days)


def test_missing_dates_over_files(spark):
    rng = random.Random(3)
    rows = [(f, dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 60))) for f in ("a", "b", None) for _ in range(60)]
    rows += [("far", dt.date(1850, 3, 1)), ("far", dt.date(2025, 3, 1)), ("one", dt.date(9999, 12, 31)), ("none", None)]
    out = cal.missing_dates(spark.createDataFrame(rows, "file string, d date").repartition(4), "d").collect()
    by = defaultdict(set)
    for f, d in rows:
        if d is not None:
            by[f].add(d)
    want = {(f, d) for f, days in by.items() for d in _holes(days)}
    assert {(r.file, r.day) for r in out if r.scope == "file"} == want
    assert sorted(r.day for r in out if r.scope == "any") == sorted({d for _, d in want})
    late = sorted(r.day for r in out if r.scope == "all")
    everything = set().union(*by.values())
    assert len(late) == (max(everything) - min(everything)).days + 1 - len(everything) and not set(late) & everything
    assert cal.missing_dates(spark.createDataFrame([], "file string, d date"), "d").count() == 0


def test_day_maps_merge(spark):
    df = spark.createDataFrame([(k % 3, dt.date(2024, 1, 1) + dt.timedelta(k)) for k in range(50)], "f int, d date")
    merged = cal.merge_day_maps(cal.day_maps(df, "d", "f"))
    assert merged.count() <= 2
    assert sorted(r.day for r in cal.map_days(merged).collect()) == sorted(r.d for r in df.collect())


def test_observed_steps(spark, tmp_dir):
    steps = quality.ObservedSteps()
    a = steps.mark(spark.range(100), "rows")
    b = steps.mark(a.filter("id % 4 = 0"), "even", after="rows")
    c = steps.mark(b.filter("id < 0"), "none", after="even")
    c.write.parquet(f"{tmp_dir}/o")
    got = [tuple(r)[:5] for r in steps.report(spark).orderBy("pos").collect()]
    assert got == [("even", 0, 100, 25, 75), ("none", 1, 25, 0, 25), ("*total*", 2, 125, 25, 100)]
    with pytest.raises(ValueError):
        steps.mark(spark.range(1), "x", after="y")


def test_chunked_digests_group_like_whole_files(spark, tmp_dir):
    rng = random.Random(4)
    bodies = [b"", b"x" * 1000, b"x" * 1001, b"x" * 1000, rng.randbytes(5000), rng.randbytes(5000)]
    bodies += [bodies[4], bodies[4][:4999] + b"!", bodies[5]]
    os.makedirs(f"{tmp_dir}/d/sub dir%")
    for k, b in enumerate(bodies):
        with open(f"{tmp_dir}/d/{'sub dir%/' if k % 2 else ''}f {k}.bin", "wb") as f:
            f.write(b)
    groups = defaultdict(list)
    for k, b in enumerate(bodies):
        if b:                                                # Spark lists no empty files
            groups[hashlib.sha256(b).hexdigest()].append(k)
    want = sorted(v for v in groups.values() if len(v) > 1)
    for chunk in (999, 1000, 1 << 20):
        out = digests.duplicate_files_below(spark, f"{tmp_dir}/d", chunk=chunk).collect()
        got = defaultdict(list)
        for r in out:
            got[r.digest].append(int(r["name"].split()[1].split(".")[0]))
        assert sorted(sorted(v) for v in got.values()) == want
        assert sum(r.keep for r in out) == len(want) and all(r.group_size == len(got[r.digest]) for r in out)


@pytest.mark.parametrize("keep", ["first", "last"])
def test_survivors_of_periods(spark, tmp_dir, keep):
    schema = "k string, ts timestamp, n long, note string"
    t = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)                                  # noqa: E731
    batches = [[("a", t(0), 1, "x"), ("a", t(0), 2, None), ("a", t(5), 3, "late in period"), ("b", t(1), 4, "b"), (None, t(2), 5, "null")],
               [("a", t(11), 6, "next"), ("b", t(6), 7, "b2")],
               [("c", t(60), 8, "pushes the watermark")],
               [("d", t(1), 9, "too late"), ("c", t(61), 10, "open")]]
    stream_dir = f"{tmp_dir}/in"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(stream_dir)
        with rocksdb(spark):
            stream = spark.readStream.schema(schema).parquet(stream_dir)
            (survivors(stream, "k", "ts", "n", "10 hours", "1 hour", keep=keep).writeStream.format("parquet")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/c").trigger(availableNow=True)
             .start().awaitTermination())
    got = sorted((r.n, r.k, r.note) for r in spark.read.schema(schema).parquet(f"{tmp_dir}/out").collect())
    want = {"first": [(1, "a", "x"), (4, "b", "b"), (5, None, "null"), (6, "a", "next")],
            "last": [(3, "a", "late in period"), (5, None, "null"), (6, "a", "next"), (7, "b", "b2")]}[keep]
    assert got == want


def _plain_survivors(rows, horizon, keep):
    """(begin, survivor) of every period of rows (key, ts, order)."""
    by, out = defaultdict(list), []
    for r in sorted(rows, key=lambda r: r[1:]):
        if not by[r[0]] or r[1] >= by[r[0]][-1][0][1] + horizon:
            by[r[0]].append([])
        by[r[0]][-1].append(r)
    for periods in by.values():
        out += [(p[0][1], p[0] if keep == "first" else p[-1]) for p in periods]
    return out


@pytest.mark.parametrize("keep", ["first", "last"])
def test_survivors_of_many_keys_are_held_by_bucket(spark, tmp_dir, keep):
    rng, schema = random.Random(11), "k string, g long, ts timestamp, n long"
    start, day = dt.datetime(2025, 1, 1), dt.timedelta(days=1)
    rows = [((f"k{rng.randint(0, 700)}", rng.choice([None, 1, 2 ** 60 + 1, 2 ** 60 + 2])), start + day * 30 * rng.random(), n)
            for n in range(6000)]
    rows += [(("k1", 1), start + day * (10 * part + 1), -1) for part in range(3)]
    for part in range(3):
        now = [(*k, ts, None if n < 0 else n) for k, ts, n in rows if (ts - start) // (10 * day) == part]
        now.append(("k1", 1, None, 9))                       # a row without a time is in no period
        spark.createDataFrame(now, schema).repartition(3).write.mode("append").parquet(f"{tmp_dir}/in")
        with rocksdb(spark):
            stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
            query = (survivors(stream, ["k", "g"], "ts", "n", "3 days", keep=keep, buckets=16).writeStream.format("parquet")
                     .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/c").trigger(availableNow=True).start())
            query.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert held and max(held) <= 16                      # one for every bucket, not for every key
    passed = max(ts for _, ts, _ in rows)
    want = [(*k, ts, None if n < 0 else n) for begin, (k, ts, n) in _plain_survivors(rows, 3 * day, keep)
            if begin + 3 * day <= passed]
    assert sorted(map(tuple, spark.read.schema(schema).parquet(f"{tmp_dir}/out").collect()), key=str) == sorted(want, key=str)


def test_stream_survivors_over_files(spark, tmp_dir):
    from orderlake.plans import checks
    from orderlake.session import scratch_path
    rng, start, day = random.Random(12), dt.datetime(2025, 1, 1), dt.timedelta(days=1)
    rows = [(n, start + day * 30 * rng.random(), rng.randint(0, 60), rng.choice(["view", "click"]), float(n)) for n in range(4000)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    before = set(os.listdir(tables)) if os.path.isdir(tables := scratch_path(spark, "").removeprefix("file:")) else set()
    got = sorted(map(tuple, checks.stream_survivors(spark, tmp_dir).collect()))
    passed = max(r[1] for r in rows) - dt.timedelta(hours=1)
    want = _plain_survivors([((r[2], r[3]), r[1], r[0]) for r in rows], 3 * day, "last")
    assert got == sorted(rows[r[2]] for begin, r in want if begin + 3 * day <= passed)
    (made,) = [x for x in os.listdir(tables) if x not in before and x.startswith("survivors-")]
    files = [f for f in os.listdir(f"{tables}/{made}/in") if f.endswith(".parquet")]
    assert len(files) > 3                                    # a part is written by all tasks and not by one


@pytest.mark.parametrize("min_ratio", [0.3, 0.6, 0.8, 0.85])
def test_fuzzy_match_of_any_ratio(spark, min_ratio):
    from difflib import SequenceMatcher

    from orderlake.operators import headers
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdeé商品名") for _ in range(n))                            # noqa: E731
    local = [word(rng.randint(1, 9)) for _ in range(25)]
    cells = [word(rng.randint(1, 9)) for _ in range(20)]
    cells += ["".join(c for c in rng.choice(local) + word(2) if rng.random() > 0.15) or "a" for _ in range(40)]
    head = spark.createDataFrame([("f", k, c) for k, c in enumerate(cells)], "file string, position int, header string")
    reg = spark.createDataFrame([(f"n{k}", t, k) for k, t in enumerate(local)], "name string, local_name string, reg_order int")
    want = {}
    first = {}
    for k, c in enumerate(cells):
        first.setdefault(c, k)
    for k, t in enumerate(local):
        if t in first:
            want[f"n{k}"] = ("exact", t, 1.0)
            continue
        scores = [(SequenceMatcher(None, t, c).ratio(), -p, c) for c, p in first.items()]
        best = max(scores)
        if best[0] > min_ratio:
            want[f"n{k}"] = ("fuzzy", best[2], best[0])
    got = {r["name"]: (r.how, r.header, r.score) for r in headers.match_fuzzy(head, reg, min_ratio).collect()}
    assert got == want
