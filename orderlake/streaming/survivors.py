"""R2 with keyed state: the surviving row of each key and horizon.

A key's first row opens a period of ``horizon``; the rows of that period are
duplicates of each other, of which one survives.  The state of a key is the
survivor so far and the period's begin.  Keys are held by ``bucket`` (hash of the
key): a bucket's state is the open periods of its keys, with one timer at the
first end among them; when the watermark passes it the survivors of the periods
that are over are emitted and gone.  Rows and state pass between the JVM and
Python by bucket, so a micro-batch costs its rows and not a call for every key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orderlake.operators._common import as_list

DEFAULT_BUCKETS = 512

_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_OPEN = pa.schema([("key", pa.string()), ("begin", pa.int64()), ("ts", pa.int64()), ("rank", pa.int64()), ("row", pa.string())])


Open = dict[str, np.ndarray]


def _pack(held: Open) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _OPEN) as w:
        w.write_batch(pa.RecordBatch.from_arrays([pa.array(held[f.name], f.type) for f in _OPEN], schema=_OPEN))
    return out.getvalue().to_pybytes()


def _unpack(state: bytes) -> Open:
    rows = pa.ipc.open_stream(state).read_next_batch()
    return {f.name: rows.column(n).to_numpy(zero_copy_only=False) for n, f in enumerate(_OPEN)}


def _only(held: Open, which: np.ndarray) -> Open:
    return {c: v[which] for c, v in held.items()}


def _periods(held: Open, new: Open, horizon: int, last: bool) -> tuple[Open, np.ndarray]:
    """The survivors of all periods of a bucket's keys, as the state holds them, and
    whether a later row of the key has ended the period."""
    n = len(held["key"])
    code, names = pd.factorize(np.concatenate([held["key"], new["key"]]))
    ts, rank, row = (np.concatenate([held[c], new[c]]) for c in ("ts", "rank", "row"))
    order = np.lexsort((rank, ts, code))                    # stable: the held row is the first among equals
    size, held_keys = len(order), code[:n]
    code, ts, rank = code[order], ts[order], rank[order]
    runs = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (ts[1:] != ts[:-1]) | (rank[1:] != rank[:-1])])
    run_ends = np.r_[runs[1:], size]
    many = run_ends - runs > 1
    for a, b in zip(runs[many].tolist(), run_ends[many].tolist()):
        order[a:b] = sorted(order[a:b].tolist(), key=lambda i: (i >= n, row[i]))
    keys = np.arange(len(names))
    first = np.searchsorted(code, keys)
    begin = ts[first]
    begin[held_keys] = held["begin"]
    # places in the order of (key, ts), times by their rank among all
    times = np.unique(ts)
    place = code * (len(times) + 1) + np.searchsorted(times, ts)

    def after(key, start):
        return np.searchsorted(place, key * (len(times) + 1) + np.searchsorted(times, start + horizon))

    follows = np.maximum(after(code, ts), np.arange(1, size + 1)).tolist()
    cuts = first.tolist()
    for s, end in zip(after(keys, begin).tolist(), np.r_[first[1:], size].tolist()):
        while s < end:                                      # a row beyond the period begins the next
            cuts.append(s)
            s = follows[s]
    cuts = np.unique(cuts)
    key, ends = code[cuts], np.r_[cuts[1:], size]
    # of rows with the same time and order the first is the last one, and the last the first one
    one = runs[np.searchsorted(runs, ends - 1, "right") - 1] if last else run_ends[np.searchsorted(runs, cuts, "right") - 1] - 1
    found = {"key": names[key], "begin": np.where(cuts == first[key], begin[key], ts[cuts]),
             "ts": ts[one], "rank": rank[one], "row": row[order[one]]}
    return found, np.r_[key[1:] == key[:-1], False]


def _survivor(horizon: int, last: bool) -> Callable:
    none = _unpack(_pack({f.name: [] for f in _OPEN}))

    def of_bucket(bucket: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, done = _unpack(state.get[0]) if state.exists else none, []
        if not state.hasTimedOut:
            rows = list(rows)                               # the bucket's rows of one micro-batch
            new = {c: np.concatenate([r[c].to_numpy(v.dtype) for r in rows]) for c, v in none.items() if c != "begin"}
            held, ended = _periods(held, new, horizon, last)
            done.append(held["row"][ended])
            held = _only(held, ~ended)
        over = (held["begin"] + horizon) // 1000 <= state.getCurrentWatermarkMs()
        done.append(held["row"][over])
        held = _only(held, ~over)
        if len(held["row"]):
            state.update((_pack(held),))
            # a timer fires when the watermark is beyond it, which is when it is at the end or later
            state.setTimeoutTimestamp(max(1, (int(held["begin"].min()) + horizon) // 1000 - 1))
        elif state.exists:
            state.remove()
        done = np.concatenate(done)
        if len(done):
            yield pd.DataFrame({"row": done})
    return of_bucket


def survivors(stream: DataFrame, keys, ts: str, order: str, horizon: str, lateness: str = "0 seconds",
              keep: str = "last", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """R2: one row per key and period of ``horizon`` of event time, itself the
    surviving row: the ``first`` or ``last`` by (``ts``, ``order``, a whole number).

    Rows more than ``lateness`` behind the watermark are dropped, as are rows
    without a time.  A survivor is emitted when its period is over, by a later row
    of its key or by the watermark, so state is held for keys of the last horizon
    only.  A task holds one of the ``buckets`` at a time, the rows that a
    micro-batch has for it and its open periods; a query keeps their number for
    as long as it keeps its checkpoint.  Start the query inside
    ``rocksdb(spark)`` to keep state out of the executors' heap."""
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    keys = as_list(keys)
    span = stream.sparkSession.sql(f"SELECT CAST(INTERVAL {horizon} AS INTERVAL DAY TO SECOND) AS i").first()["i"]
    fields = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    # 0.0 and -0.0 are one key
    names = [(F.col(f"`{k}`") + F.lit(0).cast(t) if isinstance(t := stream.schema[k].dataType, T.FractionalType)
              and not isinstance(t, T.DecimalType) else F.col(f"`{k}`")).alias(f"_k{n}") for n, k in enumerate(keys)]
    coded = stream.select(
        F.col(ts).cast("timestamp").alias("_event"), F.to_json(F.struct(*names), _FORMATS).alias("key"),
        F.coalesce(F.col(order).cast("long"), F.lit(-2 ** 63)).alias("rank"), F.to_json(fields, _FORMATS).alias("row"))
    coded = (coded.filter(F.col("_event").isNotNull()).withColumn("ts", F.unix_micros("_event"))
             .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).withWatermark("_event", lateness))
    out = coded.groupBy("bucket").applyInPandasWithState(
        _survivor(int(span.total_seconds() * 1_000_000), keep == "last"), "row string", "open binary",
        "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.from_json("row", stream.schema, _FORMATS).alias("r")).select("r.*")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)
