"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.session import scratch_path

#: Deleted or splitting white space of the text contracts: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the
    lineage, survives lost executors, and is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8(col: Column) -> Column:
    return col.cast("binary")


def ranked(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = (),
           sums: Sequence[str] = ()) -> DataFrame:
    """Number rows globally (and inside ``group``) without a one-task window.

    Rows are range-partitioned on (group, order) so that a group holding a
    third of the table spreads over many tasks; each partition counts and sums
    locally, and the per-partition totals (one row per partition and group
    present in it) are prefix-summed and joined back.  ``order`` must be a
    total order for a deterministic result.

    Adds ``_row`` (0-based inside the group) and, for every column c of
    ``sums``, ``_before_c``: the sum of c over the earlier rows of the group.
    The range-partitioned rows are written once, so that the partition number
    of a row can't change between the totals and the numbering.
    """
    spark, group = df.sparkSession, list(group)
    parts = df.repartitionByRange(shuffle_partitions(spark), *group, *order)
    rows = stored(parts.withColumn("_part", F.spark_partition_id()), name)
    totals = rows.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"),
                                               *[F.sum(c).alias(f"_t_{c}") for c in sums])
    # a group's totals: one row per partition it touches, never a row per input row
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in group],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", (F.row_number().over(inside) - 1).cast("long").alias("_r"),
                        *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_s_{c}") for c in sums])
    cond = F.col("_part") == F.col("_p")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out = local.join(offsets, cond, "left")
    return out.select(*df.columns, (F.col("_off") + F.col("_r")).alias("_row"),
                      *[(F.col(f"_off_{c}") + F.col(f"_s_{c}")).alias(f"_before_{c}") for c in sums])


def opened(uri: str):
    """(file system, path) of a folder or file in the shared store; tasks write
    real files there (``file:``, ``hdfs:``, ``s3:`` and whatever else Arrow opens)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)
