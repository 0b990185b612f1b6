"""Master-data loading (S12): JSON and YAML config files -> keyed dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions._util import is_blank
from orderlake.operators.dedupe import keep_last

from .yaml_master import YamlMaster


def load_dimension(spark: SparkSession, path: str, key: str, root: str | None = None,
                   position: str = "position") -> DataFrame:
    """Read a JSON master file (``{root: [ {...}, … ]}``, or without ``root`` one
    object per line), number entries in file order (objects that have a
    ``position`` of their own keep it), drop blank keys and keep the last entry
    per key (dict-overwrite semantics)."""
    if root:
        raw = spark.read.option("multiLine", "true").json(path)
        raw = raw.select(F.posexplode(root).alias(position, "__e")).select(position, "__e.*")
    else:
        raw = spark.read.json(path)
        if position not in raw.columns:
            raw = raw.withColumn(position, F.monotonically_increasing_id())
    raw = raw.filter(~is_blank(key))
    return keep_last(raw, key, position)


def dimension_from_map(spark: SparkSession, path: str, root: str, key: str = "key") -> DataFrame:
    """``{root: {key: {attr: …}}}`` JSON -> rows (map explode keeps file order)."""
    raw = spark.read.option("multiLine", "true").option("primitivesAsString", "true").json(path)
    m = F.from_json(F.to_json(F.col(root)), "map<string, map<string,string>>")
    return raw.select(F.posexplode(F.map_entries(m)).alias("position", "__e")) \
        .select("position", F.col("__e.key").alias(key), F.col("__e.value").alias("attrs"))


def load_yaml_dimension(spark: SparkSession, path: str, key: str = "key", columns: list[str] | None = None,
                        split_bytes: int | None = None) -> DataFrame:
    """Read YAML masters (``code: {attribute: value}`` in block style, a file or a
    folder) by byte ranges: one row per code, the last entry in (file, offset)
    order.  Entries with a blank, null or zero code or without attributes are
    dropped.  ``columns`` picks attributes (a missing one is ``''``); without it
    they come as the map ``attrs``.  Scalars keep their text (``007`` stays ``007``)."""
    spark.dataSource.register(YamlMaster)
    reader = spark.read.format("yaml_master")
    if split_bytes:
        reader = reader.option("splitBytes", split_bytes)
    rows = reader.load(path).filter(F.col("attrs").isNotNull() & ~is_blank("key"))
    rows = keep_last(rows, "key", ["file", "offset"])
    attrs = [F.col("attrs")] if columns is None else [F.coalesce(F.col("attrs")[c], F.lit("")).alias(c) for c in columns]
    return rows.select(F.col("key").alias(key), *attrs)
