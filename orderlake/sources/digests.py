"""S10 on files of any size: digests of byte ranges, read by tasks and combined.

A file's digest is the SHA-256 of its chunks' SHA-256 digests in order (a hash
tree of two levels).  Equal files have equal digests, others differ, as with a
hash of the whole file.  A task reads a chunk piece by piece, so no row or task
holds more than a piece of content, and a large file is read by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import list_files

CHUNK, PIECE = 64 << 20, 1 << 20


def opened(path: str):
    """(Arrow file system, path) of a listed path such as ``file:/a/b`` or ``hdfs://host/a/b``."""
    from pyarrow import fs
    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        digests = []
        for path, at, size in b[["path", "at", "size"]].itertuples(index=False):
            store, name = opened(path)
            h, left = hashlib.sha256(), int(size)
            with store.open_input_file(name) as f:
                f.seek(int(at))
                while left:
                    piece = f.read(min(PIECE, left))
                    if not piece:
                        raise OSError(f"{path} ends before byte {int(at) + int(size)}: it changed while it was read")
                    h.update(piece)
                    left -= len(piece)
            digests.append(h.digest())
        yield pd.DataFrame({"path": b.path, "chunk": b.chunk, "digest": digests})


def file_digests(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``files`` (path, length, ...) with ``digest``, the hash tree's root in hex."""
    chunks = (files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / chunk).cast("long"))).alias("chunk"))
        .withColumn("at", F.col("chunk") * chunk).withColumn("size", F.least(F.lit(chunk).cast("long"), F.col("length") - F.col("at"))))
    # dealt anew: the chunks of one large file come from one listing row
    leaves = (chunks.repartition("path", "chunk").select("path", "chunk", "at", "size")
              .mapInPandas(_hashed, "path string, chunk long, digest binary"))
    roots = leaves.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("chunk", "digest"))).alias("t")).select(
        "path", F.sha2(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), ""), 256).alias("digest"))
    return files.join(roots, "path")


def duplicate_files_below(spark: SparkSession, path: str, glob: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Every member of a group of files with identical bytes: path, name,
    length, digest, group_size, keep (the first path).  Only files that share
    their length are read."""
    listing = list_files(spark, path, glob=glob, exclude_dirs=()).select("path", "name", "length").checkpoint(eager=True)
    sizes = listing.groupBy("length").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("length")
    found = file_digests(listing.join(sizes, "length", "left_semi"), chunk).checkpoint(eager=True)
    groups = found.groupBy("length", "digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.min("path").alias("_first")).filter("group_size > 1")
    return found.join(groups, ["length", "digest"]).select(
        "path", "name", "length", "digest", "group_size", (F.col("path") == F.col("_first")).alias("keep"))
