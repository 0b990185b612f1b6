"""Near-duplicate detection: MinHash banding, verification, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import ranked, stored
from .components import components

BANDS, ROWS = 40, 5              # 200 universal hash minima
HASHES = BANDS * ROWS
SLICE = 1 << 20                  # bytes that are hashed at once
BLOCK, BLOCK_SHINGLES = 4096, 1_500_000     # rows and shingles of a block, about
COLUMNS = 2048                   # shingles of a block that are compared at once
#: Standard deviations below the threshold at which a signature rules a pair out.
SLACK = 6.5
MAX_ENDS = 1_000_000             # ids of candidate documents that may be broadcast (8 bytes each)

#: (prime, multiplier) of the two polynomials whose values, side by side, are a word's hash.
PRIMES = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_999_292_263))
_seeds = np.random.Generator(np.random.PCG64(20240607))
_A = (_seeds.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1))
_B = _seeds.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MIX = _seeds.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(prime: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse, up to a slice's length."""
    if prime not in _POWERS or len(_POWERS[prime][0]) <= SLICE:
        tables = []
        for x in (base, pow(base, -1, prime)):
            steps = np.ones(1, np.uint64)
            while len(steps) <= SLICE:
                steps = np.concatenate([steps, steps * np.uint64(pow(x, len(steps), prime)) % np.uint64(prime)])
            tables.append(steps)
        _POWERS[prime] = (tables[0], tables[1])
    return _POWERS[prime]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _long_word(word: np.ndarray) -> int:
    """A word's polynomials, piece by piece."""
    out = 0
    for prime, base in PRIMES:
        up, total = _powers(prime, base)[0], 0
        for at in range(0, len(word), SLICE):
            part = word[at:at + SLICE].astype(np.uint64) + np.uint64(1)
            total += pow(base, at, prime) * int((part * up[:len(part)]).sum(dtype=np.uint64))
        out = out << 32 | total % prime
    return out


def _white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first byte) of each word of lower-cased UTF-8."""
    whole, hashes, starts, at = np.frombuffer(data, np.uint8), [], [], 0
    while at < len(whole):
        part = whole[at:at + SLICE]
        white = _white(part)
        if at + SLICE < len(whole):
            ends = np.flatnonzero(white)
            if not len(ends):                                  # one word longer than a slice
                step = at + SLICE
                while step < len(whole) and not (w := _white(whole[step:step + SLICE])).any():
                    step += SLICE
                end = min(len(whole), step + int(w.argmax())) if step < len(whole) else len(whole)
                hashes.append(np.array([_long_word(whole[at:end])], np.uint64))
                starts.append(np.array([at]))
                at = end
                continue
            part, white = part[:ends[-1] + 1], white[:ends[-1] + 1]
        edge = np.diff(np.r_[True, white, True].astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums, plain = np.zeros(len(part) + 1, np.uint64), part.astype(np.uint64) + np.uint64(1)
        both = np.zeros(len(first), np.uint64)
        for prime, base in PRIMES:
            up, down = _powers(prime, base)
            np.cumsum(plain * up[:len(part)], out=sums[1:])           # below 2**60 in a slice
            value = (sums[last] - sums[first]) % np.uint64(prime) * down[first] % np.uint64(prime)
            both = both << np.uint64(32) | value
        hashes.append(both)
        starts.append(first + at)
        at += len(part)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return _mix(np.concatenate(hashes)), np.concatenate(starts)


def shingle_sets(texts: list, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text, in order."""
    group, size = [], 0
    for text in texts:
        data = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()     # A-Z only
        if group and size + len(data) >= SLICE:
            yield from _group_sets(group, words)
            group, size = [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield from _group_sets(group, words)


def _group_sets(group: list[bytes], words: int) -> Iterator[np.ndarray]:
    hashes, starts = word_hashes(b"\n".join(group))
    begin = np.cumsum([0, *(len(x) + 1 for x in group)])
    bounds = np.searchsorted(starts, begin)
    joined = np.zeros(len(hashes), np.uint64)
    m = max(0, len(hashes) - words + 1)
    for j in range(words):
        joined[:m] += hashes[j:j + m] * _MIX[j]
    joined[:m] = _mix(joined[:m])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            yield np.unique(joined[a:b - words + 1])
        elif b > a:                                            # fewer words: the whole sequence
            few = hashes[a:b]
            yield _mix((few * _MIX[:len(few)]).sum(keepdims=True, dtype=np.uint64) + _MIX[32 + len(few) % 31])
        else:
            yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of HASHES universal hashes (a x + b modulo 2**32)."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        part = short[None, at:at + 2048] * _A[:, None]
        part += _B[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    wide = minima.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((wide * _MIX[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _MIX[60])


def _signed(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("text").tolist()
            for at in range(0, len(texts), 1000):
                rows = []
                for text, x in zip(texts[at:at + 1000], shingle_sets(texts[at:at + 1000], words), strict=True):
                    if not len(x):
                        rows.append((0, None, None, None))
                        continue
                    low = signature(x)
                    rows.append((len(x), hashlib.sha256(b" ".join(text_words(text))).digest(),
                                 low.astype(np.uint16).tobytes(), band_keys(low).view(np.int64)))
                out = pd.DataFrame(rows, columns=["n_shingles", "word_hash", "sig", "bands"])
                out.insert(0, "doc_id", batch.doc_id.to_numpy()[at:at + 1000])
                yield out.astype({"doc_id": "Int64"})
    return run


def least_matches(percent: int) -> int:
    """Signature matches below which a pair can't reach the similarity, but for
    SLACK standard deviations."""
    t = percent / 100
    return max(1, math.floor(HASHES * t - SLACK * math.sqrt(HASHES * t * (1 - t))))


def _by_signature(percent: int):
    least = least_matches(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a = np.frombuffer(b"".join(batch.sig_a), np.uint16).reshape(-1, HASHES)
                b = np.frombuffer(b"".join(batch.sig_b), np.uint16).reshape(-1, HASHES)
                yield batch[(a == b).sum(axis=1) >= least][["u", "v"]]
    return run


def text_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()     # A-Z and ASCII white space, as the contract's


def text_shingles(text: str, words: int) -> set:
    w = text_words(text)
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _by_sets(words: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_id, held = None, set()
        for batch in batches:
            good = []
            for u, v, a, b in batch[["u", "v", "text_a", "text_b"]].itertuples(index=False):
                if v != held_id:                       # pairs of one hub come together
                    held_id, held = v, text_shingles(b, words)
                good.append(similar(text_shingles(a, words), held, percent))
            yield batch[np.array(good, bool)][["u", "v"]] if len(batch) else batch[["u", "v"]]
    return run


def _few(ids: DataFrame) -> DataFrame:
    return sized_broadcast(stored(ids, "minhash-ids"), MAX_ENDS)


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Distinct candidate pairs (u, v) that their signatures and then their full
    shingle sets confirm."""
    sig = nodes.select("node", "sig", "n_shingles")
    a = sig.select(F.col("node").alias("u"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    b = sig.select(F.col("node").alias("v"), F.col("sig").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    close = (pairs.join(a, "u").join(b, "v")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
             .select("u", "v", "sig_a", "sig_b").mapInPandas(_by_signature(percent), "u long, v long"))
    close = stored(close, "minhash-close")
    ends = close.select(F.col("u").alias("doc_id")).union(close.select("v")).distinct()
    own = texts.join(_few(ends), "doc_id", "left_semi")
    full = (close.join(own.select(F.col("doc_id").alias("u"), F.col("text").alias("text_a")), "u")
            .join(own.select(F.col("doc_id").alias("v"), F.col("text").alias("text_b")), "v")
            .sortWithinPartitions("v"))
    return stored(full.mapInPandas(_by_sets(words, percent), "u long, v long"), "minhash-links")


def _shared(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets (``right``
    None: with each other), summed over slices of the shingles that two rows
    share."""
    both = left if right is None else [*left, *right]
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, column, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    if right is None:
        used = count > 1
    else:
        in_left = np.bincount(column[row < len(left)], minlength=len(count))
        used = (in_left > 0) & (in_left < count)
    place = np.cumsum(used) - 1
    keep = used[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(both) - len(left) if right is not None else len(left)), np.float32)
    for at in range(0, int(used.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        dense = np.zeros((len(both), COLUMNS), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        out += dense[:len(left)] @ (dense if right is None else dense[len(left):]).T
    return out


def _cells(words: int, percent: int):
    """Links between different components inside one cell of a bucket: the full
    sets of all pairs are compared, and no more links leave than join the
    cell's components."""
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        within = cell.lo.iloc[0] == cell.hi.iloc[0]
        left = cell[cell.block == cell.lo]
        right = left if within else cell[cell.block == cell.hi]
        out: list[tuple[int, int]] = []
        if len(left) and len(right) and cell.label.nunique() > 1:
            own = list(shingle_sets(left.text.tolist(), words))
            other = own if within else list(shingle_sets(right.text.tolist(), words))
            shared = _shared(own, None if within else other)
            sizes, labels = np.array([len(x) for x in other]), right.label.to_numpy()
            root = {x: x for x in cell.label.tolist()}

            def find(x):
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            for i, (node, label, text) in enumerate(left[["node", "label", "text"]].itertuples(index=False)):
                linked = 100 * shared[i] >= percent * (len(own[i]) + sizes - shared[i])
                for j in np.flatnonzero(linked & (labels != label)):
                    a, b = find(label), find(labels[j])
                    if a != b and similar(text_shingles(text, words), text_shingles(right.text.iloc[j], words), percent):
                        root[max(a, b)] = min(a, b)
                        out.append((node, right.node.iloc[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return run


def _rest_links(rest: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links in buckets (key) of several components (label): members are dealt
    to blocks of bounded size, and each pair of blocks is one cell."""
    sizes = rest.groupBy("key").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("_blocks"))
    own = texts.join(_few(rest.select(F.col("node").alias("doc_id")).distinct()), "doc_id", "left_semi")
    dealt = (rest.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    cells = dealt.join(own.withColumnRenamed("doc_id", "node"), "node").select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "node", "label", "text")
    found = cells.groupBy("key", "lo", "hi").applyInPandas(_cells(words, percent), "u long, v long")
    return stored(found, "minhash-rest")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    A document's set is its distinct ``words``-word shingles of the text with
    A-Z lower-cased, words being ``[^\\x20\\x09-\\x0D]+``; a text of fewer words
    is one shingle; a null text or one without words has an empty set and is
    linked with nothing.  Documents with 100 |A and B| >= percent |A or B| are
    linked; component_id is the smallest doc_id reachable.  Repeated rows get a
    row each; rows that share a doc_id count as one document of several sets.

    1. Rows of equal words (by the SHA-256 of the sequence) are one node (its
       smallest id).  Nodes of equal sets share all bands, and are confirmed like others.
    2. Nodes that share a band of BANDS are candidates: each bucket's members
       against its smallest node (a star, linear in the bucket).
       Signatures rule pairs out, the full shingle sets confirm the others.
    3. Buckets that then still hold several components are compared in cells of
       two bounded blocks, on full shingle sets inside a task.  No pair is left
       out, and no more rows leave a cell than it joins components.
    At the threshold itself a pair shares no band with a chance of
    (1 - s**ROWS)**BANDS: 1e-10 for 0.85, 1e-7 for 0.8.
    """
    rows = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        _signed(words), "doc_id long, n_shingles long, word_hash binary, sig binary, bands array<long>"),
        "minhash-sets")
    classes = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("word_hash").agg(
        F.min("doc_id").alias("node"))
    nodes = stored(
        rows.join(classes, "word_hash").filter("doc_id = node").dropDuplicates(["word_hash"])
        .select("node", "n_shingles", "sig", "bands"), "minhash-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("_last")).filter("hub <> _last")
    buckets = stored(banded.join(hubs.drop("_last"), "key"), "minhash-buckets")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    stars = buckets.filter("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    links = _verified(stars, nodes, texts, words, percent)
    labels = components(links)
    # buckets of several components: all members but the hub, which has been compared
    marked = buckets.filter("node <> hub").join(labels, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("label"))
    open_keys = marked.groupBy("key").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a <> _b")
    rest = stored(marked.join(open_keys.select("key"), "key").join(nodes.select("node", "n_shingles"), "node"),
                  "minhash-open")
    final = labels if rest.isEmpty() else components(links.union(_rest_links(rest, texts, words, percent)))
    named = classes.join(final, "node", "left").select("word_hash", F.coalesce("component", "node").alias("_component"))
    return rows.join(named, "word_hash", "left").select(
        "doc_id", "n_shingles", F.coalesce("_component", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (nulls
    first, then by the text's MD5); columns as they were.  Where doc_ids repeat
    or are null, every row is a document of its own, numbered in that order."""
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])       # names may clash
    own_id, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    repeated = plain.groupBy(own_id).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(own_id).isNull())
    key = own_id
    if repeated.head(1):
        key = "_row"
        plain = stored(ranked(plain.withColumn("_tie", F.md5(F.col(text))), [own_id, "_tie"], "near-ranges").drop("_tie"),
                       "near-rows")
    near = near_duplicates(plain.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), words, percent)
    gone = sized_broadcast(stored(near.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")), "minhash-gone"),
                           MAX_ENDS)
    left = plain.join(gone, F.col(key) == F.col("_gone"), "left_anti").drop("_row")
    return left.toDF(*docs.columns)
