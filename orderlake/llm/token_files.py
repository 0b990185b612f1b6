"""Token-ID files: frequency-ranked ids, byte-aligned, control bytes apart.

File layout (little-endian), one or more blocks after another:

    magic "TKB1", uint32 documents, uint64 ids, uint32 ranks, uint64 data bytes
    uint32[ranks]          id of each rank, most frequent in the block first
    int64[documents]       doc_id (the least int64 for null)
    uint32[documents]      ids of each document
    uint8[ceil(ids / 4)]   control bytes: two bits an id, data bytes less one
    uint8[data bytes]      ranks in 1 to 4 bytes each

A rank below 256 takes one data byte, so the commonest ids take 1.25 bytes.
Decoding looks the four lengths of each control byte up in a table and gathers
the data bytes with numpy.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, compress, filterfalse, repeat
from operator import not_

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import opened, ranked, scratch, shuffle_partitions, stored

MAGIC, HEAD = b"TKB1", struct.Struct("<4sIQIQ")
NULL_ID = np.iinfo(np.int64).min
BLOCK_IDS = 4_000_000          # ids of a block, and one document more at most
MEMO = 700_000                 # pieces of a generation; a worker remembers two
LETTERS = "[A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ӿ]+"         # letters in every version of Unicode
#: A word with marks behind it, and perhaps a line's first word after them.
PARTS = re.compile(f"({LETTERS})([.,;:!?]+)(?:(\n)({LETTERS})([.,;:!?]*))?")
SPARK_BLOCKS = "path string, part int, block int, block_offset long, block_bytes long, n_ids long"

#: Lengths of the four ids of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


class Pieces:
    """Ids of whole texts, from the tokenizers library, piece by piece.

    The byte-level pre-tokenizer never joins a character that isn't white space
    with a following space, so a text may be cut there and its pieces encoded
    (and remembered) one by one.  Spaces after other white space stay inside
    their piece.  A new piece of words and marks (``PARTS``) is put together from
    the ids of its word, which most often are known, and those of the rest.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True       # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        names = [self.tokenizer.id_to_token(k) or "" for k in range(size)]
        cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ab.\nCd,") if self.tokenizer.pre_tokenizer else []
        self.parted = {3, 5, 7} <= {at for _, (at, _) in cuts}        # words, marks and a line's first word are cut
        self.opens = np.array([x.startswith("Ġ") for x in names])     # begins with the space byte
        self.memo: dict[str, bytes | bool] = {}           # text after a space; True: look at the whole text
        self.past: dict[str, bytes | bool] = {}           # the generation before
        self.odd: dict[str, bytes] = {}                   # pieces as they are

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        plain, parts, rest = {}, [], []
        for p in new:
            known = self.past.get(p)
            if known is not None:
                self.memo[p] = known
            elif not p or p[-1].isspace():
                self.memo[p] = True
            elif self.parted and (m := PARTS.fullmatch(p)):
                word, marks, feed, first, more = m.groups()
                after = (marks + feed, first, more) if feed else (marks,)
                parts.append((p, word, after))
                rest.extend(after)
                if word not in self.memo:
                    known = self.past.get(word)
                    if known is None:
                        plain[word] = None
                    else:
                        self.memo[word] = known
            else:
                plain[p] = None
        plain = list(plain)
        for at in range(0, len(plain), 20_000):
            groups = [plain[k:k + 100] for k in range(at, min(at + 20_000, len(plain)), 100)]
            for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups]), strict=True):
                begin = np.flatnonzero(self.opens[ids])   # a piece has one space, its first byte
                if len(begin) == len(group) and begin[0] == 0:
                    raw, places = ids.tobytes(), (begin * ids.itemsize).tolist()
                    self.memo.update((p, raw[a:b]) for p, a, b in zip(group, places, [*places[1:], len(raw)], strict=True))
                else:
                    for p, x in zip(group, self._encode([" " + p for p in group]), strict=True):
                        self.memo[p] = x.tobytes()
        self._odd(rest)
        for p, word, after in parts:
            self.memo[p] = b"".join([self.memo[word], *map(self.odd.__getitem__, after)])

    def _odd(self, pieces: list[str]) -> list[bytes]:
        new = list(dict.fromkeys(filterfalse(self.odd.__contains__, pieces)))
        self.odd.update((p, x.tobytes()) for p, x in zip(new, self._encode(new), strict=True))
        return [self.odd[p] for p in pieces]

    @staticmethod
    def _whole(parts: list[str]) -> list[str]:
        """Pieces of a text with spaces after other white space."""
        out = [parts[0]]
        for p in parts[1:]:
            if not out[-1] or out[-1][-1].isspace():
                out[-1] += " " + p
            else:
                out.append(" " + p)
        return out

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 256):
            if len(self.memo) > MEMO:
                self.past, self.memo = self.memo, {}
            if len(self.odd) > MEMO // 4:
                self.odd = {}
            split = [t.split(" ") for t in texts[at:at + 256]]
            flat = list(chain.from_iterable(split))
            found = list(map(self.memo.get, flat, repeat(b"")))       # no piece has no ids
            new = list(compress(range(len(flat)), map(not_, found)))
            self._learn(list(dict.fromkeys(flat[k] for k in new)))
            for k in new:
                found[k] = self.memo[flat[k]]
            end = 0
            for parts in split:
                begin, end = end, end + len(parts)
                try:
                    if len(parts) > 1 and (not parts[0] or parts[0][-1].isspace()):
                        raise TypeError
                    first = self._odd(parts[:1])[0] if parts[0] else b""
                    yield np.frombuffer(first + b"".join(found[begin + 1:end]), self.kind)
                except TypeError:                         # True among the pieces
                    yield np.frombuffer(b"".join(self._odd([p for p in self._whole(parts) if p])), self.kind)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """(id of each rank, control bytes, data bytes)."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    used = np.flatnonzero(counts)
    order = used[np.argsort(-counts[used], kind="stable")].astype(np.uint32)      # ties: the smaller id first
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    ranks = rank_of[ids].astype("<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fours = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    fours[:len(ranks)] = more
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    return order, control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ids(order: np.ndarray, control: bytes, data: bytes, n: int) -> np.ndarray:
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begin = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[begin].astype(np.uint32)
    for k in (1, 2, 3):
        wide = np.flatnonzero(length > k)
        ranks[wide] |= raw[begin[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return order[ranks]


def write_block(out, doc_ids: list, docs: list[np.ndarray]) -> int:
    """Write one block; returns its bytes."""
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    order, control, data = encode_ids(ids)
    parts = [HEAD.pack(MAGIC, len(docs), len(ids), len(order), len(data)), order.astype("<u4").tobytes(),
             np.array([NULL_ID if pd.isna(x) else x for x in doc_ids], "<i8").tobytes(),
             np.array([len(x) for x in docs], "<u4").tobytes(), control, data]
    for x in parts:
        out.write(x)
    return sum(map(len, parts))


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, ids of each document, all ids)."""
    magic, n_docs, n_ids, n_ranks, n_data = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("no token block")
    at = HEAD.size
    order = np.frombuffer(block, "<u4", n_ranks, at)
    at += 4 * n_ranks
    doc_ids = np.frombuffer(block, "<i8", n_docs, at)
    at += 8 * n_docs
    counts = np.frombuffer(block, "<u4", n_docs, at)
    at += 4 * n_docs
    mid = at + -(-n_ids // 4)
    return doc_ids, counts, decode_ids(order, block[at:mid], block[mid:mid + n_data], n_ids)


def _write(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        uri = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.tkb"   # one name an attempt
        coder, end = pieces(path), None
        store, name = opened(uri)
        out, at, blocks, held_ids, held, size = None, 0, [], [], [], 0

        def flush():
            nonlocal out, at, held_ids, held, size
            if out is None:
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(name, compression=None)
            written = write_block(out, held_ids, held)
            blocks.append((uri, task.partitionId(), len(blocks), at, written, size))
            at += written
            held_ids, held, size = [], [], 0

        for batch in batches:
            texts = batch.text.tolist()
            end = np.array([end_id], np.promote_types(coder.kind, np.min_scalar_type(end_id)))
            for doc_id, ids in zip(batch.doc_id.tolist(), coder.ids(texts), strict=True):
                held_ids.append(doc_id)
                held.append(np.concatenate([ids, end]))
                size += len(ids) + 1
                if size >= BLOCK_IDS:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        yield pd.DataFrame(blocks, columns=[x.split()[0] for x in SPARK_BLOCKS.split(", ")])
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text) in ascending doc_id order;
    returns the manifest, one row per block.

    Whole texts are encoded without special tokens, a null text as empty, and
    ``end_id`` follows each document.  Null ids go first; rows that share an id
    are ordered by a hash of their text.  An empty table writes no file.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return stored(sorted_rows.mapInPandas(_write(folder, tokenizer, end_id), SPARK_BLOCKS), "token-manifest")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri, offset, size, start in batch[["path", "block_offset", "block_bytes", "_before_n_ids"]].itertuples(
                index=False):
            store, name = opened(uri)
            with store.open_input_file(name) as f:
                f.seek(int(offset))
                doc_ids, counts, ids = read_block(f.read(int(size)))
            ends = np.cumsum(counts.astype(np.int64))
            wide = ids.astype("<u4")
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(ends - counts, ends, strict=True)]
            yield pd.DataFrame({"doc_id": pd.Series(doc_ids).astype("Int64").mask(doc_ids == NULL_ID),
                                "start": start + ends - counts, "n_tokens": counts.astype(np.int64),
                                "ids_crc32": np.array(crc, np.int64)})


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of
    ``manifest``; a block's start is the prefix sum over the blocks before it."""
    placed = ranked(manifest, ["part", "block"], "token-starts", sums=["n_ids"])
    return placed.repartition(shuffle_partitions(spark), "path", "block").mapInPandas(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, scratch(spark, "tokens"), tokenizer, end_id))
