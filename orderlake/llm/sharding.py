"""Sharding by global byte-size prefix sums (built-in functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, stored, utf8

#: Bytes that a row costs besides its text.
ROW_BYTES = 8


def shard_by_bytes(rows: DataFrame, order: Sequence[str], size: str, shards: int) -> DataFrame:
    """Cut ``rows``, in the total order ``order``, into ``shards`` contiguous
    shards of near-equal bytes; adds ``shard`` and ``slot``.

    A row goes to the shard in which the middle of its bytes falls, when the
    total is cut at equal targets; a shard's bytes thus differ from the target
    by less than one row at either end.  ``slot`` counts from 0 inside the
    shard, in the order.  Sizes must be positive.  A table with fewer rows than
    shards leaves shards empty; an empty table gives no rows.  Null order
    columns sort first.  The prefix sums come from per-partition totals: no
    window sees more than one range partition's rows or one row per partition.
    """
    numbered = stored(ranked(rows, order, "shard-ranges", sums=[size]), "shard-prefix")
    total = numbered.agg(F.sum(size)).first()[0] or 1     # one value
    cut = numbered.withColumn(
        "shard", F.least(F.lit(shards - 1), F.floor(
            (F.col(f"_before_{size}") + F.col(size) / 2) * F.lit(shards) / F.lit(total))).cast("int"))
    first = cut.groupBy(F.col("shard").alias("_s")).agg(F.min("_row").alias("_first"))  # one row per shard
    return cut.join(F.broadcast(first), F.col("shard") == F.col("_s")).select(
        *rows.columns, "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in ``shards`` shards of near-equal bytes (law ``bytes``).

    The order is (64-bit text hash, id): rows of equal texts are neighbours, so
    a group of copies shares a shard unless a cut falls inside it, and a group
    of any size is cut like other rows.  A null text counts as empty: size 8,
    crc32 of no bytes (0).  Repeated rows are kept, each with a slot of its own.
    """
    text = utf8(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text).cast("long") + F.lit(ROW_BYTES)).alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_key"))
    rows = stored(rows.withColumn("_uid", F.monotonically_increasing_id()), "shard-rows")
    out = shard_by_bytes(rows, ["_key", "doc_id", "_uid"], "size", shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
