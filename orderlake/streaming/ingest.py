"""Structured Streaming ingest.

The target is a versioned table (see ``sources.versions``).  A micro-batch adds
one folder with its own rows, one per key, in files by ``bucket`` (hash of the
key), so its cost follows the batch and not the table.  Readers keep the winner
of each key over all folders of one manifest; ``compact_epochs`` folds them into
one folder from time to time.  The manifest names each writer's last batch, so a
replayed batch is a no-op, and a query with a new checkpoint is another writer,
whose batches come after those that are there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators._common import as_list
from orderlake.operators.dedupe import keep_best
from orderlake.session import hadoop_path
from orderlake.sources import versions as V

DEFAULT_BUCKETS = 64


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _winners(rows: DataFrame, rule: dict) -> DataFrame:
    """One row per key: the latest ``ts`` (if given), then the newest generation,
    then the greatest ``order``."""
    spec = ([(rule["ts"], False)] if rule["ts"] else []) + [("generation", False)] + [(c, False) for c in rule["order"]]
    return keep_best(rows, rule["keys"], spec, tiebreak_ascending=False)


def current_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The winner of every key as of ``version`` (default: the newest), without
    the layout columns.  A target that no micro-batch has written yet is a frame
    without columns and rows."""
    seen = V.manifest(spark, path, version)
    if seen is None:
        return spark.createDataFrame([], T.StructType([]))
    return _winners(V.read_folders(spark, path, seen), seen["rule"]).drop("bucket", "generation")


def _wider(old: dict | None, new: T.StructType) -> dict:
    """The target's columns and those a batch adds; a column keeps its type."""
    out = T.StructType.fromJson(old) if old else T.StructType([])
    for f in new.fields:
        if f.name not in out.names:
            out = out.add(f.name, f.dataType)
        elif out[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {out[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return out.jsonValue()


def upsert_batch(batch: DataFrame, epoch: int, target: str, keys, ts: str | None = None,
                 order=None, buckets: int = DEFAULT_BUCKETS, writer: str = "batches") -> None:
    """Add one micro-batch to the target (see module docstring).  ``epoch`` counts
    the batches of ``writer``; one that is not after its last is a replay."""
    spark = batch.sparkSession
    rule = {"buckets": buckets, "keys": as_list(keys), "ts": ts, "order": as_list(order)}
    state: dict = {}

    def put():
        seen = V.manifest(spark, target)
        if seen is not None and seen["rule"] != rule:
            raise ValueError(f"the target was written with {seen['rule']}, not {rule}")
        if seen is not None and seen["writers"].get(writer, -1) >= int(epoch):
            return
        if "name" not in state:
            rows = batch.withColumn("bucket", _bucket(rule["keys"], buckets)).withColumn("generation", F.lit(0))
            # one file per bucket and micro-batch
            out = _winners(rows, rule).drop("generation").repartition(buckets, "bucket")
            state["schema"], state["name"] = out.schema, V.write_folder(out, target, ["bucket"])
        version = 0 if seen is None else seen["version"] + 1
        V.commit(spark, target, seen, {
            "rule": rule, "schema": _wider(seen and seen["schema"], state["schema"]),
            "folders": [*(seen["folders"] if seen else []), {"name": state["name"], "generation": version}],
            "writers": {**(seen["writers"] if seen else {}), writer: int(epoch)}})
    if not batch.isEmpty():
        V.retry(put)


def compact_epochs(spark: SparkSession, target: str) -> int:
    """Fold the folders of the target into one; returns how many there were (0:
    nothing to fold).

    Micro-batches may be committed meanwhile: their folders stay beside the new
    one.  Old folders stay for readers of older versions until
    ``sources.versions.expire``.
    """
    seen = V.manifest(spark, target)
    if seen is None or len(seen["folders"]) < 2:
        return 0
    rule, folded = seen["rule"], {f["name"] for f in seen["folders"]}
    rows = _winners(V.read_folders(spark, target, seen), rule).drop("generation")
    name = V.write_folder(rows.repartition(rule["buckets"], "bucket"), target, ["bucket"])
    base = {"name": name, "generation": max(f["generation"] for f in seen["folders"])}

    def put():
        last = V.manifest(spark, target)
        if not folded <= {f["name"] for f in last["folders"]}:
            return 0                                     # another compaction was first; ours stays unnamed
        V.commit(spark, target, last, {"folders": [base, *(f for f in last["folders"] if f["name"] not in folded)]})
        return len(folded)
    return V.retry(put)


def _writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a streaming query: kept with its checkpoint, so that a
    restart has the same and a new checkpoint another one."""
    path = f"{checkpoint.rstrip('/')}/_orderlake_writer"
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        fs.mkdirs(p.getParent())
        V._create_if_absent(spark, path, uuid.uuid4().hex)
    return V._read_text(spark, path)


def ingest_stream(spark: SparkSession, source: str, schema: T.StructType, target: str,
                  checkpoint: str, keys, ts: str | None = None, order=None,
                  clean: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet",
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  buckets: int = DEFAULT_BUCKETS, options: dict | None = None) -> StreamingQuery:
    """File stream -> clean -> keyed upsert into ``target`` per micro-batch.

    The newest arrival wins per key (or the latest ``ts``); there is no
    lateness bound, so the state is the target table, not operator state.
    """
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.load(source)
    if clean is not None:
        stream = clean(stream)
    writer = _writer_of(spark, checkpoint)

    def fold(batch: DataFrame, epoch: int) -> None:
        upsert_batch(batch, epoch, target, keys, ts=ts, order=order, buckets=buckets, writer=writer)

    w = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def suppress_duplicates(stream: DataFrame, keys, ts: str, horizon: str = "1 day") -> DataFrame:
    """R2: emit each key once within ``horizon`` of event time.

    Watermarks need a TIMESTAMP; a TIMESTAMP_NTZ event time is read in the
    session time zone through a helper column, leaving the original intact."""
    if dict(stream.dtypes).get(ts) == "timestamp_ntz":
        out = stream.withColumn("__event_time", F.col(ts).cast("timestamp"))
        return (out.withWatermark("__event_time", horizon)
                .dropDuplicatesWithinWatermark(as_list(keys)).drop("__event_time"))
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(as_list(keys))
