"""Packing into length buckets whose bounds minimise padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import ranked, scratch, stored, utf8

#: Longest sequence; longer texts come in several pieces, none is dropped or cut short.
MAX_LENGTH = 8192
BUCKETS = 16
#: Padded tokens of a batch.
BATCH_TOKENS = 65_536
#: Token ids: 0 to 255 are bytes.
END, PAD = 256, 257


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise
    sum(count * (bound - length)), by dynamic programming over the histogram.

    ``lengths`` are ascending and distinct.  With best[k][j] the least padding of
    the first j lengths in k buckets, best[k][j] = min over i < j of
    best[k-1][i] + (padding of lengths i..j-1 up to length j-1).  Ties prefer
    the smallest i.  Fewer distinct lengths than buckets give one bucket each.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    m = len(lengths)
    if not m:
        return []
    n = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    k = min(buckets, m)
    best = np.full(m + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts = np.zeros((k + 1, m + 1), np.int64)
    for b in range(1, k + 1):
        now = np.full(m + 1, np.iinfo(np.int64).max // 4)
        for j in range(b, m + 1):
            cost = best[b - 1:j] + lengths[j - 1] * (n[j] - n[b - 1:j]) - (tokens[j] - tokens[b - 1:j])
            i = int(cost.argmin())
            now[j], cuts[b, j] = cost[i], b - 1 + i
        best = now
    bounds, j = [], m
    for b in range(k, 0, -1):
        bounds.append(int(lengths[j - 1]))
        j = int(cuts[b, j])
    return bounds[::-1]


def _fitted(lengths: DataFrame, buckets: int) -> list[int]:
    """Bounds from counts (n_tokens, n); the driver reads one count per length."""
    histogram = lengths.groupBy("n_tokens").agg(F.sum("n").alias("n")).orderBy("n_tokens").toPandas()
    return bucket_bounds(histogram.n_tokens.to_numpy(), histogram.n.to_numpy(), buckets)


def pack(docs: DataFrame, buckets: int = BUCKETS, max_length: int = MAX_LENGTH,
         batch_tokens: int = BATCH_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token-budget batches of byte-level tokens inside optimal length buckets.

    A text's tokens are its UTF-8 bytes and one end token, so a null or empty
    text has one.  A text of more than ``max_length`` tokens comes in pieces of
    that length and a rest.  One row per piece: doc_id, piece, start (first
    token), n_tokens, bucket, bound (padded length), padding, batch (inside the
    bucket) and place (row of the batch).  A batch has at most
    batch_tokens // bound rows (at least one), in ascending (doc_id, piece)
    order; all batches of a bucket but the last are full.  The histogram has at
    most ``max_length`` bins, the only thing that the driver reads.  Repeated
    rows are packed as often as they come; null ids go first; an empty table
    gives no rows.
    """
    tokens = F.octet_length(utf8(F.coalesce(F.col(text_col), F.lit("")))).cast("long") + 1
    sized = docs.select(F.col(id_col).alias("doc_id"), tokens.alias("_total"))
    last = F.floor((F.col("_total") - 1) / max_length).cast("int")
    pieces = stored(
        sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start", F.col("piece").cast("long") * max_length)
        .withColumn("n_tokens", F.least(F.lit(max_length).cast("long"), F.col("_total") - F.col("start")))
        .drop("_total").withColumn("_uid", F.monotonically_increasing_id()), "pack-pieces")
    histogram = pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").toPandas()
    bounds = bucket_bounds(histogram.n_tokens.to_numpy(), histogram.n.to_numpy(), buckets)
    bucket = bound = F.lit(None).cast("int")
    for k in reversed(range(len(bounds))):
        fits = F.col("n_tokens") <= bounds[k]
        bucket, bound = F.when(fits, k).otherwise(bucket), F.when(fits, bounds[k]).otherwise(bound)
    placed = ranked(pieces.withColumn("bucket", bucket.cast("int")).withColumn("bound", bound.cast("int")),
                    ["doc_id", "piece", "_uid"], "pack-ranges", group=["bucket"])
    rows = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bound"))).cast("long")
    return placed.select("doc_id", "piece", "start", "n_tokens", "bucket", "bound",
                         (F.col("bound") - F.col("n_tokens")).alias("padding"),
                         F.floor(F.col("_row") / rows).alias("batch"), (F.col("_row") % rows).cast("int").alias("place"))


def _dense(slices: pd.Series, lengths: pd.Series, bounds: pd.Series) -> pd.Series:
    """A batch's matrix of token ids, unsigned 16-bit little-endian, row by row."""
    import zstandard

    out, unpack = [], zstandard.ZstdDecompressor()
    for rows, sizes, bound in zip(slices, lengths, bounds, strict=True):
        ids = np.full((len(rows), bound), PAD, "<u2")
        for k, (row, n) in enumerate(zip(rows, sizes, strict=True)):
            row = np.frombuffer(unpack.decompress(row), np.uint8)
            ids[k, :len(row)] = row
            ids[k, len(row):n] = END             # one place after a text's last piece, none after the others
        out.append(ids.tobytes())
    return pd.Series(out, dtype=object)


def _numbered(bounds: list[int]):
    """Adds each piece's bucket, the partition, and its number in that partition's
    pieces of the bucket, and compresses its bytes, which are shuffled later."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        pack, part, counts = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId(), np.zeros(len(bounds), np.int64)
        for b in batches:
            bucket = np.searchsorted(bounds, b["n_tokens"].to_numpy(zero_copy_only=False)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            seen = np.bincount(bucket, minlength=len(bounds))
            nth = np.empty(len(bucket), np.int64)
            nth[order] = np.arange(len(bucket)) - np.repeat(np.cumsum(seen) - seen, seen)
            slices = pa.array([pack.compress(x) for x in b["slice"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["piece"], b["start"], b["n_tokens"], slices, pa.array(bucket),
                 pa.array(np.asarray(bounds, np.int32)[bucket]), pa.array(np.full(len(bucket), part, np.int32)),
                 pa.array(counts[bucket] + nth)],
                names=["doc_id", "piece", "start", "n_tokens", "slice", "bucket", "bound", "_part", "_nth"])
            counts += seen
    return run


def write_batches(docs: DataFrame, folder: str, buckets: int = BUCKETS, max_length: int = MAX_LENGTH,
                  batch_tokens: int = BATCH_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Batches as those of ``pack``, but with their tokens and filled in the order of
    the input's partitions, as Parquet in ``folder``: one row per batch with bucket, batch, bound, the arrays doc_id, piece, start and
    n_tokens by place, and ids, the dense matrix of one row per place padded to
    ``bound`` (see ``matrix``).  Cases are those of ``pack``; other columns of
    ``docs`` are ignored.  A text is sliced once, whatever its length, and a
    batch holds at most ``batch_tokens`` ids or one row.  Texts are read twice, for
    the histogram and for the slices; these are written and shuffled once, compressed.
    """
    body = utf8(F.coalesce(F.col(text_col), F.lit("")))
    sized = docs.select(F.col(id_col).alias("doc_id"), body.alias("_body")).withColumn(
        "_total", F.octet_length("_body").cast("long") + 1)
    last = F.floor((F.col("_total") - 1) / max_length).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        i.alias("piece"), F.substring(F.col("_body"), i * max_length + 1, F.lit(max_length)).alias("slice"),
        F.least(F.lit(max_length).cast("long"), F.col("_total") - i.cast("long") * max_length).alias("n_tokens")))
    pieces = sized.select("doc_id", cut.alias("_cut")).select("doc_id", F.inline("_cut")).withColumn(
        "start", F.col("piece").cast("long") * max_length)
    whole = (sized.select(F.floor((F.col("_total") - 1) / max_length).alias("_full"), (
        (F.col("_total") - 1) % max_length + 1).alias("_rest")).groupBy("_rest").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_full").alias("_full")))
    sizes = F.array(F.struct(F.col("_rest").alias("n_tokens"), F.col("n")),
                    F.struct(F.lit(max_length).cast("long").alias("n_tokens"), F.col("_full").alias("n")))
    lengths = whole.select(F.inline(sizes)).filter("n > 0")
    bounds = _fitted(lengths, buckets)
    kind = docs.schema[id_col].dataType.simpleString()
    numbered = stored(pieces.mapInArrow(_numbered(bounds), f"""doc_id {kind}, piece int, start long, n_tokens long,
        slice binary, bucket int, bound int, _part int, _nth long"""), "pack-slices")
    before = Window.partitionBy("bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("_part", "bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    most = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bound"))).cast("long")
    row = F.col("_off") + F.col("_nth")
    rows = numbered.join(sized_broadcast(stored(offsets, "pack-offsets")), ["_part", "bucket"]).withColumn(
        "batch", F.floor(row / most)).withColumn("place", (row % most).cast("int"))
    batches = rows.groupBy("bucket", "batch", "bound").agg(F.sort_array(F.collect_list(
        F.struct("place", "doc_id", "piece", "start", "n_tokens", "slice"))).alias("_r"))
    dense = F.pandas_udf(_dense, "binary")
    batches.select("bucket", "batch", "bound", "_r.doc_id", "_r.piece", "_r.start", "_r.n_tokens",
                   dense("_r.slice", "_r.n_tokens", "bound").alias("ids")).write.option(
                       "compression", "zstd").parquet(folder)


def matrix(ids: bytes, n_tokens, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(token ids, mask of those that aren't padding) of one written batch."""
    mask = np.arange(bound)[None, :] < np.asarray(n_tokens)[:, None]
    return np.frombuffer(ids, "<u2").reshape(-1, bound), mask


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    """One row per piece of the batches in ``folder``: the columns of ``pack`` and
    tokens_crc32, of its ids (unsigned 16-bit little-endian) without padding."""
    rows = F.transform(F.arrays_zip("doc_id", "piece", "start", "n_tokens"), lambda x, i: F.struct(
        x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["start"].alias("start"), x["n_tokens"].alias("n_tokens"),
        F.crc32(F.substring(F.col("ids"), i * F.col("bound") * 2 + 1, x["n_tokens"].cast("int") * 2)).alias("tokens_crc32"),
        i.alias("place")))
    return (spark.read.parquet(folder).select("bucket", "batch", "bound", rows.alias("_rows"))
            .select("bucket", "batch", "bound", F.inline("_rows"))
            .select("doc_id", "piece", "start", "n_tokens", "bucket", "bound",
                    (F.col("bound") - F.col("n_tokens")).alias("padding"), "batch", "place", "tokens_crc32"))


def batch_round_trip(docs: DataFrame, **kw) -> DataFrame:
    """Write the batches of ``docs`` in the shared folder and read their pieces back."""
    spark = docs.sparkSession
    folder = scratch(spark, "pack-batches")
    write_batches(docs, folder, **kw)
    return read_batches(spark, folder)
