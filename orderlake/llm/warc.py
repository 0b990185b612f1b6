"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a footer in a skippable
frame lists the frames' sizes (the public "seekable" layout: magic 0x184D2A5E,
per frame two little-endian 32-bit sizes, then frame count, descriptor byte and
magic 0x8F92EAB1).  The index maps a record identifier to (file, frame, offset
inside the decompressed frame), so one record costs one small read and one
frame's decompression.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import opened, scratch, shuffle_partitions, stored, utf8

# fixed values of the seekable Zstandard layout and of WARC 1.1
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

FRAME_BYTES = 256 * 1024
INDEX_SCHEMA = "page_id long, path string, frame int, record_offset long, record_bytes long"
FRAME_SCHEMA = "path string, frame int, frame_offset long, frame_bytes long"
RECORD_SCHEMA = ("page_id long, record_type string, refers_to long, target_uri string, "
                 "payload_bytes long, payload_digest string, header_digest string")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _identifier(page_id) -> str:
    return "<urn:page:unknown>" if pd.isna(page_id) else f"<urn:page:{int(page_id)}>"


def record(page_id, url, payload: bytes | None, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit has no payload (``payload`` None)."""
    head = ["WARC/1.1", "WARC-Type: " + ("revisit" if payload is None else "response"),
            f"WARC-Record-ID: {_identifier(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_identifier(refers_to)}"]
    block = HTTP_HEAD + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that begins at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, data[begin:end], end + 4


def footer(frames: list[tuple[int, int]]) -> bytes:
    """Seek table of (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def seek_table(f) -> list[tuple[int, int]]:
    """(offset, compressed bytes) of each frame, from the end of an open file."""
    size = f.size()
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(size - 9 - 8 * n)
    sizes = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    out, at = [], 0
    for k in range(n):
        out.append((at, sizes[2 * k]))
        at += sizes[2 * k]
    return out


def _write_bundle(folder: str, date: str, level: int, frame_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        task = TaskContext.get()
        # a name of the attempt: a retried or speculative task never touches a file
        # that the committed index points to
        name = f"bundle-{task.partitionId():06d}-{task.taskAttemptId()}.warc.zst"
        store, path = opened(f"{folder}/{name}")
        press = zstandard.ZstdCompressor(level=level)
        out, frames, held, size, index = None, [], [], 0, []

        def flush():
            nonlocal out, held, size
            if out is None:
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(path, compression=None)   # the bytes are packed already
            packed = press.compress(b"".join(held))
            out.write(packed)
            frames.append((len(packed), size))
            held, size = [], 0

        for batch in batches:
            index = []
            for page_id, url, payload, digest, refers in zip(batch.page_id, batch.url, batch.payload, batch.digest,
                                                             batch.refers_to, strict=True):
                bare = base64.b32encode(bytes.fromhex(digest)).decode()
                rec = record(page_id, url, payload, bare, refers, date)
                if held and size + len(rec) > frame_bytes:
                    flush()
                index.append((page_id, f"{folder}/{name}", len(frames), size, len(rec)))
                held.append(rec)
                size += len(rec)
            yield pd.DataFrame(index, columns=["page_id", "path", "frame", "record_offset", "record_bytes"]).astype(
                {"page_id": "Int64"})
        if held:
            flush()
        if out is not None:
            out.write(footer(frames))
            out.close()
    return write


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2026-01-01T00:00:00Z",
                   level: int = 3, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); return the index.

    Of rows with equal payloads (SHA-1 and length) of at least ``min_bytes``
    bytes, those with the largest page_id are responses and the others revisit
    it; smaller payloads are all responses.  A null html is an empty payload, a
    null url leaves out its header, a null page_id is never revisited unless
    all ids of its group are null; repeated rows give repeated records.  An
    empty table writes no file.
    """
    payload = utf8(F.coalesce("html", F.lit("")))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"),
                        F.octet_length(payload).cast("long").alias("size"))
    heads = rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("_head"))
    other = F.col("_head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_head"))
    typed = rows.join(heads, ["digest", "size"], "left").select(
        "page_id", "url", F.when(~other, F.col("payload")).alias("payload"), "digest",
        F.when(other, F.col("_head")).alias("refers_to"))
    index = typed.sortWithinPartitions("page_id").mapInPandas(
        _write_bundle(folder, date, level, frame_bytes), INDEX_SCHEMA)
    return stored(index, "warc-index")


def _frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri in batch.path:
            store, path = opened(uri)
            with store.open_input_file(path) as f:
                table = seek_table(f)
            yield pd.DataFrame([(uri, k, *x) for k, x in enumerate(table)],
                               columns=["path", "frame", "frame_offset", "frame_bytes"])


def read_frame(uri: str, offset: int, size: int) -> bytes:
    import zstandard

    store, path = opened(uri)
    with store.open_input_file(path) as f:
        f.seek(int(offset))
        return zstandard.ZstdDecompressor().decompress(f.read(int(size)))


def _number(identifier: str | None) -> int | None:
    tail = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(tail) if re.fullmatch(r"-?\d+", tail) else None


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri, offset, size in zip(batch.path, batch.frame_offset, batch.frame_bytes, strict=True):
            data, at, rows = read_frame(uri, offset, size), 0, []
            while at < len(data):
                head, block, at = parse(data, at)
                payload = block[block.index(b"\r\n\r\n") + 4:]
                revisit = head["WARC-Type"] == "revisit"
                rows.append((_number(head["WARC-Record-ID"]), head["WARC-Type"], _number(head.get("WARC-Refers-To")),
                             head.get("WARC-Target-URI"), None if revisit else len(payload),
                             None if revisit else digest32(payload),
                             head["WARC-Payload-Digest"].removeprefix("sha1:")))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD_SCHEMA.split(", ")]).astype(
                {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """All records of the archives that ``index`` names, from their seek tables;
    each frame is decompressed by itself, in any task."""
    n = shuffle_partitions(spark)
    files = index.select("path").distinct()
    frames = files.mapInPandas(_frames, FRAME_SCHEMA)
    return frames.repartition(n, "path", "frame").mapInPandas(_records, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back, and
    return per record page_id, payload_bytes, payload_digest, record_type and
    refers_to.  A revisit takes length and digest from the response that it
    refers to; a missing response or another digest is an error."""
    spark = pages.sparkSession
    records = stored(read_archives(spark, write_archives(pages, scratch(spark, "warc"), min_bytes)), "warc-records")
    first = records.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(
        F.col("page_id").alias("_of"), F.col("payload_digest").alias("_digest")).agg(
        F.max("payload_bytes").alias("_bytes"))
    joined = records.filter("record_type = 'revisit'").join(
        first, (F.col("refers_to") == F.col("_of")) & (F.col("header_digest") == F.col("_digest")), "left")
    wrong = F.raise_error(F.concat(F.lit("a revisit's response is missing: "), F.col("refers_to").cast("string")))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = joined.select("page_id", F.coalesce("_bytes", wrong.cast("long")).alias("payload_bytes"),
                             F.col("_digest").alias("payload_digest"), "record_type", "refers_to")
    return records.filter("record_type = 'response'").select(*cols).unionByName(revisits)
