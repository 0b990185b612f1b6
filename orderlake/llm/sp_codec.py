"""SentencePiece (BPE model) encoding and decoding by suffix-array matching.

New distinct segments of a batch (a run of word marks and the characters up to
the next run) are concatenated and indexed in a suffix array; every piece of
the vocabulary is binary-searched in it, which gives all of its occurrences at
once.  The occurrences are edges from a piece's first to its last character.
Sorted by position, they are relaxed from left to right.

The model is a BPE model, for which the best path isn't the one with the
highest sum of scores but the one that merging by score ends in.  A path is
that one exactly if every two neighbours on it, merged from characters by
themselves, stay these two pieces.  So an edge is relaxed if its piece can
follow the piece that the path to its start ends with; there is one such edge
for each end.  Runs of three and more word marks, whose merges have equal
scores, are merged directly.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MEMO = 500_000                 # segments of a generation; a worker remembers two
CHARS = 500_000              # characters of new segments in one suffix array, about
SEPARATOR, UNSEEN = 0, 1       # codes of characters that no piece has


BPE = 2                        # model_type of a BPE model


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value
    while at < len(message):
        tag = varint()
        kind = tag & 7
        size = varint() if kind == 2 else {0: 0, 1: 8, 5: 4}[kind]
        if kind == 0:
            yield tag >> 3, varint()
        else:
            yield tag >> 3, message[at:at + size]
            at += size


def model_type(proto: bytes) -> int:
    """trainer_spec (field 2) . model_type (field 3) of a model file; 1, a
    unigram model, is its default."""
    spec = b"".join(v for n, v in _fields(proto) if n == 2)
    return [1, *(v for n, v in _fields(spec) if n == 3)][-1]


class Model:
    """Vocabulary of a SentencePiece BPE model with byte fallback, identity
    normalisation and a dummy prefix.  Ids and characters are held in 16 or 32
    bits, as the vocabulary needs; a model of another type is refused."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        if (found := model_type(lib.serialized_model_proto())) != BPE:
            raise ValueError(f"{path} is no BPE model (model_type {found})")
        self.size = lib.get_piece_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.byte_id = np.zeros(256, np.int64)
        self.score: dict[str, tuple[float, int]] = {}
        self.plain: list[bytes] = []
        for k in range(self.size):
            piece = lib.id_to_piece(k)
            if lib.is_byte(k):
                value = int(piece[3:-1], 16)
                self.byte_id[value] = k
                self.plain.append(bytes([value]))
            elif lib.is_control(k) or lib.is_unknown(k) or lib.is_unused(k):
                self.plain.append(b"")
            else:
                self.score[piece] = (lib.get_score(k), k)
                self.plain.append(piece.replace(MARK, " ").encode())
        # pieces that merging can end in, by code points
        pieces = [(p, k) for p, (_, k) in self.score.items() if set(p) == {MARK} or self.merge(p) == [p]]
        chars = sorted({c for p, _ in pieces for c in p})
        self.wide = np.uint16 if len(chars) < 0xFFF0 else np.uint32   # its largest value is no character's code
        self.code = np.full(0x110000, UNSEEN, self.wide)
        self.code[[ord(c) for c in chars]] = np.arange(2, len(chars) + 2, dtype=self.wide)
        self.lone = np.zeros(len(chars) + 2, bool)            # codes that are pieces by themselves
        self.lone[[self.code[ord(p)] for p, _ in pieces if len(p) == 1]] = True
        self.longest = -(-max(len(p) for p, _ in pieces) // 4) * 4
        self.lengths = np.array([len(p) for p, _ in pieces])
        self.ids = np.array([k for _, k in pieces])
        self.patterns = np.zeros((len(pieces), self.longest), self.wide)
        for row, (p, _) in zip(self.patterns, pieces, strict=True):
            row[:len(p)] = [self.code[ord(c)] for c in p]
        self.text = {k: p for p, (_, k) in self.score.items()}
        self.follows: dict[int, bool] = {}                    # pairs asked lately; others in sorted arrays
        self.asked, self.answer = np.zeros(0, np.int64), np.zeros(0, bool)
        self.memo: dict[str, bytes] = {}
        self.past: dict[str, bytes] = {}                      # the generation before

    def merge(self, text: str) -> list[str]:
        """Pieces of a text by merging: the highest score first, then the leftmost."""
        parts: list[str | None] = list(text)
        right = list(range(1, len(parts) + 1))
        left = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(parts) and (s := self.score.get(both := parts[i] + parts[right[i]])):
                heapq.heappush(heap, (-s[0], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or right[i] >= len(parts) or parts[i] + parts[right[i]] != both:
                continue
            gone = right[i]
            parts[i], parts[gone] = both, None
            right[i] = right[gone]
            if right[gone] < len(parts):
                left[right[gone]] = i
            offer(left[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _may_follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the pieces with these ids stay apart next to each other."""
        keys, place = np.unique(before * self.size + after, return_inverse=True)
        out = np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.asked, keys), max(len(self.asked) - 1, 0))
        old = self.asked[at] == keys if len(self.asked) else out.copy()
        out[old] = self.answer[at[old]]
        rest = np.flatnonzero(~old)
        for n, key in zip(rest.tolist(), keys[rest].tolist(), strict=True):
            known = self.follows.get(key)
            if known is None:
                a, b = self.text[key // self.size], self.text[key % self.size]
                known = self.follows[key] = self.merge(a + b) == [a, b]
            out[n] = known
        if len(self.follows) > 1 << 15:
            full = len(self.asked) > 4 * MEMO
            new = np.fromiter(self.follows, np.int64, len(self.follows))
            said = np.fromiter(self.follows.values(), bool, len(self.follows))
            keys_, said = (new, said) if full else (np.append(self.asked, new), np.append(self.answer, said))
            order = np.argsort(keys_)
            self.asked, self.answer = keys_[order], said[order]
            self.follows.clear()
        return out[place]

    def _keys(self, column) -> list[np.ndarray]:
        """64-bit keys of the characters ``column(0)``, ``column(1)``, ...: four or two to a key."""
        bits = 8 * np.dtype(self.wide).itemsize
        out = []
        for k in range(0, self.longest, 64 // bits):
            key = column(k).astype(np.uint64)
            for j in range(1, 64 // bits):
                key = key << np.uint64(bits) | column(k + j)
            out.append(key)
        return out

    def _index(self, codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Suffix array of ``codes`` (by as many characters as the longest piece
        has) and the suffixes' characters as keys."""
        padded = np.concatenate([codes, np.zeros(self.longest, self.wide)])
        columns = self._keys(lambda k: padded[k:k + len(codes)])
        order = np.lexsort(columns[::-1])
        return order, [c[order] for c in columns]

    def _range(self, columns: list[np.ndarray], patterns: np.ndarray) -> np.ndarray:
        """First suffix that isn't less than each pattern, by binary search."""
        keys = self._keys(lambda k: patterns[:, k])
        n = len(columns[0])
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), n)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            at = np.minimum(mid, n - 1)
            less, same = np.zeros(len(patterns), bool), np.ones(len(patterns), bool)
            for column, key in zip(columns, keys, strict=True):
                less |= same & (column[at] < key)
                same &= column[at] == key
            low = np.where(open_ & less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        return low

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id) of every occurrence of every piece; characters
        that no piece is are edges of id -1."""
        order, columns = self._index(codes)
        first = self._range(columns, self.patterns)
        above = self.patterns.copy()
        above[np.arange(above.shape[1]) >= self.lengths[:, None]] = np.iinfo(self.wide).max
        count = self._range(columns, above) - first
        hit = np.flatnonzero(count)
        begin = np.cumsum(count[hit]) - count[hit]
        at = np.arange(count[hit].sum()) + np.repeat(first[hit] - begin, count[hit])
        alone = np.flatnonzero(~self.lone[codes] & (codes != SEPARATOR))
        return (np.concatenate([order[at], alone]),
                np.concatenate([np.repeat(self.lengths[hit], count[hit]), np.ones(len(alone), np.int64)]),
                np.concatenate([np.repeat(self.ids[hit], count[hit]), np.full(len(alone), -1)]))

    def match(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments by suffix-array matching, and where each one's end."""
        text = "\0".join(segments) + "\0"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        sizes = np.array([len(s) for s in segments])
        starts = np.cumsum(sizes + 1) - sizes - 1
        codes[starts + sizes] = SEPARATOR
        begin, length, ids = self._edges(codes)
        offset_of = np.arange(len(codes)) - np.repeat(starts, sizes + 1)
        ends = offset_of[begin] + length                     # in the segment
        order = np.lexsort((length, begin, ends))
        begin, length, ids, ends = begin[order], length[order], ids[order], ends[order]
        cuts = np.searchsorted(ends, np.arange(1, int(sizes.max(initial=0)) + 2))
        last = np.full(len(codes) + 1, -2)                   # id that the path to a position ends with
        came = np.zeros(len(codes) + 1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            b0, n, k = begin[a:b], length[a:b], ids[a:b]
            before = last[b0]
            good = (offset_of[b0] == 0) | ((before == -1) | (k == -1)) & (before > -2)
            ask = np.flatnonzero(~good & (before >= 0))
            if len(ask):
                good[ask] = self._may_follow(before[ask], k[ask])
            to = (b0 + n)[good]
            last[to], came[to] = k[good], b0[good]
        return self._trace(points, starts, sizes, last, came)

    def _trace(self, points, starts, sizes, last, came) -> tuple[np.ndarray, np.ndarray]:
        """Walk back from the segments' ends, all at once."""
        at, owner, found = starts + sizes, np.arange(len(starts)), []
        while len(at):
            open_ = at > starts[owner]
            at, owner = at[open_], owner[open_]
            found.append((owner, came[at], last[at]))
            at = came[at]
        owner = np.concatenate([x[0] for x in found])
        place = np.concatenate([x[1] for x in found])
        ids = np.concatenate([x[2] for x in found])
        order = np.lexsort((place, owner))
        owner, place, ids = owner[order], place[order], ids[order]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):                                     # bytes of characters without a piece
            raw = [self.byte_id[list(chr(p).encode("utf-8", "surrogatepass"))] for p in points[place[unknown]].tolist()]
            count = np.ones(len(ids), np.int64)
            count[unknown] = [len(x) for x in raw]
            spelt = np.repeat(ids < 0, count)
            owner, ids = np.repeat(owner, count), np.repeat(ids, count)
            ids[spelt] = np.concatenate(raw)
        return ids, np.searchsorted(owner, np.arange(len(starts)), "right")

    def _direct(self, segment: str) -> list[int]:
        out = []
        for p in self.merge(segment):
            out += [self.score[p][1]] if p in self.score else [
                int(self.byte_id[b]) for b in p.encode("utf-8", "surrogatepass")]
        return out

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of new segments, under their text without the first mark."""
        known = [s for s in new if s in self.past]
        self.memo.update(zip(known, map(self.past.__getitem__, known), strict=True))
        new = list(filterfalse(self.memo.__contains__, new)) if known else new
        runs = {s for s in new if s.startswith(MARK + MARK)}     # with the first mark, three and more
        for s in runs:
            self.memo[s] = np.array(self._direct(MARK + s), self.kind).tobytes()
        group, size = [], 0
        for s in [*filterfalse(runs.__contains__, new), None]:
            if group and (s is None or size >= CHARS):
                ids, ends = self.match([MARK + p for p in group])
                raw, ends = ids.astype(self.kind).tobytes(), (ends * self.kind.itemsize).tolist()
                self.memo.update((p, raw[a:b]) for p, a, b in zip(group, [0, *ends[:-1]], ends, strict=True))
                group, size = [], 0
            if s is not None:
                group.append(s)
                size += len(s) + 2

    @staticmethod
    def segments(text: str) -> list[str]:
        """Segments of a text, each without its first mark."""
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return parts
        out, run = [], ""
        for p in parts:
            if p:
                out.append(run + p)
                run = ""
            else:
                run += MARK
        return [*out, run[1:]] if run else out

    def encode(self, texts: list) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 512):
            if len(self.memo) > MEMO:
                self.past, self.memo = self.memo, {}
            split = [self.segments(t) if t else [] for t in texts[at:at + 512]]
            new: set[str] = set()
            for parts in split:
                new.update(filterfalse(self.memo.__contains__, parts))
            self._learn(sorted(new))
            for parts in split:
                yield np.frombuffer(b"".join(map(self.memo.__getitem__, parts)), self.kind)

    def decode(self, ids) -> str:
        """Text of ids: byte pieces joined as UTF-8 (what isn't becomes U+FFFD),
        marks as spaces, without the dummy prefix."""
        raw = b"".join(map(self.plain.__getitem__, np.asarray(ids).tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text and ids (array) of every whole text; null and empty texts have none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model(path)
        for batch in batches:
            texts = batch.text.tolist()
            for at in range(0, len(texts), 1024):
                yield pd.DataFrame({"doc_id": batch.doc_id.iloc[at:at + 1024], "text": batch.text.iloc[at:at + 1024],
                                    "ids": [x.astype(np.int32) for x in own.encode(texts[at:at + 1024])]})

    rows = docs.select("doc_id", "text")
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, ids array<int>")


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """``coded`` with ``decoded``, the text of its ids."""
    decode = F.pandas_udf(lambda ids: ids.map(lambda x: model(path).decode(x)), "string")
    return coded.withColumn("decoded", decode("ids"))


def codec_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_ids, ids_crc32 (of unsigned 32-bit little-endian
    ids), decoded_crc32 (of the decoded text in UTF-8) and round_trip (the decoded
    text is the text, but for word marks, which read as spaces).

    A null text counts as empty: no ids, crc32 0, round_trip true.  Repeated rows
    get a row each; an empty table gives none.
    """
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = model(path)
        for batch in batches:
            texts = batch.text.tolist()
            rows = []
            for text, ids in zip(texts, own.encode(texts), strict=True):
                back = own.decode(ids)
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(back.encode()),
                             back == (text or "").replace(MARK, " ")))
            out = pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "decoded_crc32", "round_trip"])
            out.insert(0, "doc_id", batch.doc_id.to_numpy())
            yield out

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        digest, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
