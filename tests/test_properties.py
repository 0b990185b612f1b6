"""Properties from SURVEY §5: order independence, idempotence, batch = stream."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.operators import dedupe
from orderlake.operators import sequence as sq
from orderlake.operators import upsert as up
from orderlake.streaming import current_table, ingest_stream

ROWS = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=40)
SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows, reverse=False):
    data = list(reversed(rows)) if reverse else rows
    return spark.createDataFrame(data, "k int, seq int, v string").repartition(3)


@SLOW
@given(ROWS)
def test_keep_last_ignores_input_order(spark, rows):
    a = dedupe.keep_last(_df(spark, rows), "k", "seq")
    b = dedupe.keep_last(_df(spark, rows, reverse=True), "k", "seq")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == len({r[0] for r in rows})


@SLOW
@given(ROWS, ROWS)
def test_upsert_idempotent(spark, old, new):
    o, n = _df(spark, old), _df(spark, new)
    once = up.upsert(o, n, "k", order=["seq"])
    assert up.upsert(once, n, "k", order=["seq"]).exceptAll(once).count() == 0


@SLOW
@given(ROWS)
def test_number_within_is_a_permutation_per_group(spark, rows):
    out = sq.number_within(_df(spark, rows), "k", ["seq"], partitions=3).collect()
    by = {}
    for r in out:
        by.setdefault(r["k"], []).append(r["seq"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())


def test_stream_equals_batch_over_many_micro_batches(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=(i * 37) % 500), i % 7, ["view", "click"][i % 2], float(i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double")
    for part in range(3):                                   # three file drops
        df.filter(F.col("event_id") % 3 == part).coalesce(1).write.parquet(f"{tmp_dir}/drops/d{part}")
    q = ingest_stream(spark, f"{tmp_dir}/drops/*", df.schema, f"{tmp_dir}/target", f"{tmp_dir}/ckpt",
                      keys=["user_id", "event_type"], ts="ts", order=["event_id"], buckets=4,
                      max_files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3                      # really folded batch by batch
    streamed = current_table(spark, f"{tmp_dir}/target").select(*df.columns)
    batch = dedupe.keep_latest(df, ["user_id", "event_type"], "ts", "event_id")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
