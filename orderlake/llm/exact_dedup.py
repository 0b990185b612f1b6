"""Exact dedup: 128-bit content hash, byte comparison inside groups (built-in functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import WHITE, stored, utf8

#: Rows of one hash that are compared with the kept text in one salted part.
SALT_ROWS = 4096
#: Hashes of repeated texts that may be broadcast (24 bytes each).
MAX_HASHES = 1_000_000


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(utf8(text)))


def _compared(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` (_h, _uid, _points, doc_id, _norm) of repeated hashes that differ
    in bytes from the text that their hash's best row has.

    The best rows are found with a partial group limit before the shuffle.
    A hash of many rows is split into salted parts of about SALT_ROWS rows, and
    its best text goes to each of them.
    """
    best = Window.partitionBy("_h").orderBy(F.desc("_points"), "doc_id", "_uid")
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / SALT_ROWS)).cast("int")
    heads = (rows.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
             .select("_h", "_n", F.col("_norm").alias("_head"))
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "_uid"), parts).cast("int"))
    return salted.join(heads, ["_h", "_salt"]).filter(F.col("_norm") != F.col("_head")).drop("_salt", "_head")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash128: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space; a null text
    counts as empty.  Of equal texts the row with the most code points in the
    original text stays, then the smallest doc_id (null ids last), then any one
    of fully repeated rows.  Rows are grouped by ``hash128`` of the normalised
    text.  Inside groups of two or more, bytes are compared with the best row's
    text; rows that differ (hash collisions) form groups of their own, again
    and again until none differ.  Only repeated hashes carry texts into a
    shuffle.  An empty table gives no rows; other columns are ignored.
    """
    norm = normalised(F.col(text_col))
    narrow = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_points"),
                    norm.alias("_norm"))
            .select("doc_id", "_points", hash128(F.col("_norm")).alias("_h"),
                    F.unhex(F.sha2(utf8(F.col("_norm")), 256)).alias("_sha"))
            .withColumn("_uid", F.monotonically_increasing_id()), "exact-rows")
    groups = stored(narrow.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "exact-groups")
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_points"),
                         norm.alias("_norm"))
             .withColumn("_h", hash128(F.col("_norm")))
             .join(sized_broadcast(groups, MAX_HASHES), "_h")
             .withColumn("_uid", F.monotonically_increasing_id()))
    differ = stored(_compared(texts, groups), "exact-differ")
    moved, level = None, 0
    while not differ.isEmpty():                      # only after a collision of the 128-bit hash
        level += 1
        here = differ.groupBy("_h", "_norm").agg(F.count(F.lit(1)).alias("_k"))
        counts = here.groupBy("_h").agg(F.sum("_k").alias("_n"))
        here = stored(here.select("_h", F.unhex(F.sha2(utf8(F.col("_norm")), 256)).alias("_sha")), "exact-moved")
        here = here.withColumn("_level", F.lit(level))
        moved = here if moved is None else moved.union(here)
        differ = stored(_compared(differ.drop("_n").join(counts, "_h"), counts), "exact-differ")
    if moved is None:
        rows = narrow.withColumn("_level", F.lit(0))
    else:
        last = moved.groupBy("_h", "_sha").agg(F.max("_level").alias("_level"))
        rows = narrow.join(last, ["_h", "_sha"], "left").withColumn("_level", F.coalesce("_level", F.lit(0)))
    best = F.struct(F.col("_points"), F.col("doc_id").isNotNull().alias("_some"), (-F.col("doc_id")).alias("_id"),
                    (-F.col("_uid")).alias("_u"))
    classes = rows.groupBy("_h", "_level").agg(F.max(best).alias("_best"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(classes, ["_h", "_level"]).select(
        "doc_id", (-F.col("_best._id")).alias("keep_id"), "group_size",
        (F.col("_uid") == -F.col("_best._u")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns as they were
    (also those named like this operator's own)."""
    columns = docs.columns
    docs = docs.toDF(*[f"c{k}" for k in range(len(columns))])
    id_col, text_col = (f"c{columns.index(c)}" for c in (id_col, text_col))
    judged = stored(exact_dedup(docs, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept"), "exact-judged")
    pairs = judged.groupBy("_id", "_sha").agg(F.max("kept").alias("_some"), F.min("kept").alias("_all"))
    gone = stored(pairs.filter("NOT _all"), "exact-gone")
    marked = docs.withColumn("_own", F.unhex(F.sha2(utf8(normalised(F.col(text_col))), 256)))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha"))
    left = marked.join(sized_broadcast(gone, MAX_HASHES), same, "left_anti")
    repeated = gone.filter("_some")                  # rows that share id and text with the kept one
    if not repeated.isEmpty():
        once = Window.partitionBy(id_col, "_own").orderBy(F.desc(F.length(F.coalesce(F.col(text_col), F.lit("")))))
        first = marked.join(sized_broadcast(repeated, MAX_HASHES), same, "left_semi").withColumn(
            "_one", F.row_number().over(once)).filter("_one = 1").drop("_one")
        left = left.unionByName(first)
    return left.drop("_own").toDF(*columns)
