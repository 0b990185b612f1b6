"""A training-data pipeline over ``documents``: language ID, exact dedup,
near dedup, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept.  The first three return the columns of ``documents``; the
last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import exact_dedup, langid, minhash, packing
from orderlake.llm.common import stored
from orderlake.session import ensure_checkpoint_dir, ship_package


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that no learned language explains go."""
    _ready(spark)
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one document of each group of equal texts stays."""
    _ready(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near copies stays (five-word
    shingles, similarity 0.8 or more)."""
    _ready(spark)
    return minhash.drop_near_copies(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token-budget batches inside optimal length buckets."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("packing", packed)]

#: SQL can express neither the language filter nor the bucket bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
