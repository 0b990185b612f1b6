"""Ranked lexical search by dual trees.

Items and documents are sparse vectors over the items' terms (weights, and
impacts of the term counts); a score is their inner product.  Blocks of
documents and the items each get a binary tree whose nodes hold the largest
value of every coordinate.  The product of two nodes' maxima bounds every score
between them, so a pair of nodes is dropped when its bound is below the weakest
k-th score of the node's items.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import UPPER, ranked, stored

#: Every byte outside [0-9A-Za-z] and 0x80-0xFF ends a term; A-Z are lower-cased.
_TERM = set(b"0123456789abcdefghijklmnopqrstuvwxyz" + UPPER.encode()) | set(range(0x80, 0x100))
TABLE = bytes((b + 32 if chr(b) in UPPER else b) if b in _TERM else 0x20 for b in range(256))
#: Slots of the term filter: a fixed size, whatever the number of items.
SLOTS = 1 << 22
#: Text is split into terms in pieces of about so many bytes.
PIECE = 1 << 20
#: A block of documents: at most so many rows and about so many term counts.
BLOCK_ROWS, BLOCK_TERMS = 4096, 1 << 20
DOC_LEAF, ITEM_LEAF = 64, 8
#: Items are searched in batches of about so many bytes, each broadcast.
ITEM_BYTES = 16 << 20
#: About so many documents are ranked first; their k-th scores start the search.
SEED_DOCS = 16_384
#: Rows are split by their leading direction in a random projection of so many dimensions.
DIMS = 32


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text."""
    flat, counts, at = text.translate(TABLE), Counter(), 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE) if at + PIECE < len(flat) else -1
        end = len(flat) if end < 0 else end
        counts.update(flat[at:end].split())
        at = end
    return counts


def _list(lists: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(lists, pa.list_(kind))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        terms = [sorted(term_counts(t)) if t else [] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), _list(terms, pa.binary())], ["_item", "terms"])


def _postings(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little").tobytes()
        for b in batches:
            size, terms, counts = [], [], []
            for text in b.column(1).to_pylist():
                all_terms = term_counts(text) if text else {}
                kept = [t for t in all_terms if seen[crc32(t) & (SLOTS - 1)]]
                size.append(sum(all_terms.values()))
                terms.append(kept)
                counts.append([all_terms[t] for t in kept])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), _list(terms, pa.binary()),
                                              _list(counts, pa.int64())], ["doc_id", "n", "terms", "tfs"])
    return run


def _filter_bits(terms: DataFrame) -> bytes:
    """One bit per slot: whether an item term's CRC falls on it (SLOTS / 8 bytes)."""
    slot = F.pmod(F.crc32("term"), F.lit(SLOTS)) + 1
    rows = (terms.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")).collect())
    out = bytearray(SLOTS // 8)
    for r in rows:
        out[(r["b"] - 1) * 4096:r["b"] * 4096] = r["bits"]
    return bytes(out)


def _ranges(ptr: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ptr[i]..ptr[i + 1] - 1 of all ``nodes``, and where each one's begin."""
    size = ptr[nodes + 1] - ptr[nodes]
    begin = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(ptr[nodes] - begin, size), begin


class Tree:
    """Sparse rows in a binary tree of even depth: level l has 2^l nodes, and
    ``levels[l]`` the coordinate maxima of each as (ptr, idx, val); ``rows`` are
    the vectors themselves, ``order`` the original row at each place.  No row is empty."""

    def __init__(self, ptr: np.ndarray, idx: np.ndarray, val: np.ndarray, width: int, leaf: int):
        n = len(ptr) - 1
        signs = np.random.default_rng(7).integers(0, 2, (width, DIMS)).astype(np.float32) * 2 - 1
        flat = np.add.reduceat(signs[idx] * val[:, None].astype(np.float32), ptr[:-1], axis=0)
        flat /= np.maximum(np.sqrt((flat ** 2).sum(axis=1, keepdims=True)), 1e-30)
        depth, order, edges = 0, np.arange(n), np.array([0, n])
        self.edges = [edges]
        while n > leaf << depth:
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                part = order[s:e]
                near = flat[part] - flat[part].mean(axis=0)
                along = near @ np.linalg.eigh(near.T @ near)[1][:, -1]
                order[s:e] = part[np.argpartition(along, (e - s) // 2)]
            middle = (edges[:-1] + edges[1:]) // 2
            edges = np.sort(np.concatenate([edges, middle]))
            depth += 1
            self.edges.append(edges)
        place, _ = _ranges(ptr, order)
        self.order, self.depth, self.width = order, depth, width
        self.rows = (np.concatenate([[0], np.cumsum(ptr[order + 1] - ptr[order])]), idx[place], val[place])
        at = np.repeat(np.arange(n), np.diff(self.rows[0]))
        node, idx, val = np.searchsorted(edges, at, "right") - 1, self.rows[1], self.rows[2]
        self.levels = []
        for level in reversed(range(depth + 1)):
            key = node * width + idx
            by = np.argsort(key, kind="stable")
            key = key[by]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            node, idx, val = key[first] // width, key[first] % width, np.maximum.reduceat(val[by], first)
            self.levels.append((np.searchsorted(node, np.arange((1 << level) + 1)), idx, val))
            node = node // 2
        self.levels.reverse()


class Best:
    """The k best (score, id) of every item so far; ids may be null (last)."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.score, self.id = np.zeros((items, k), np.int64), np.full((items, k), np.iinfo(np.int64).max)
        self.null, self.k = np.ones((items, k), bool), k
        self.least = least                          # scores below are out: a k-th score found elsewhere, or 1
        self.bar = least.copy()

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[item], score]), np.concatenate([self.id[item], ids])
        null = np.concatenate([self.null[item], null])
        top = np.lexsort((ids, null, -score))[:self.k]
        self.score[item], self.id[item], self.null[item] = score[top], ids[top], null[top]
        self.bar[item] = max(self.least[item], self.score[item, -1])


class Search:
    """One block of documents against all items of a batch, depth first."""

    def __init__(self, items: Tree, docs: Tree, ids: np.ndarray, null: np.ndarray, best: Best):
        self.items, self.docs, self.best = items, docs, best
        self.ids, self.null = ids[docs.order], null[docs.order]
        self.z, self.local = np.zeros(docs.width, docs.rows[2].dtype), np.full(docs.width, -1)
        self.scored = 0
        everything = np.zeros(1, np.int64)
        self.visit(0, 0, 0, everything, self.bounds(0, 0, 0, everything))

    def bounds(self, doc_level: int, node: int, item_level: int, alive: np.ndarray) -> np.ndarray:
        ptr, idx, val = self.docs.levels[doc_level]
        mine = idx[ptr[node]:ptr[node + 1]]
        self.z[mine] = val[ptr[node]:ptr[node + 1]]
        ptr, idx, val = self.items.levels[item_level]
        place, begin = _ranges(ptr, alive)
        out = np.add.reduceat(val[place] * self.z[idx[place]], begin)
        self.z[mine] = 0
        return out

    def visit(self, doc_level: int, node: int, item_level: int, alive: np.ndarray, bound: np.ndarray) -> None:
        weakest = np.minimum.reduceat(self.best.bar[self.items.order], self.items.edges[item_level][:-1])
        alive = alive[bound >= weakest[alive]]
        if not len(alive):
            return
        items_down, docs_down = item_level < self.items.depth, doc_level < self.docs.depth
        if not items_down and not docs_down:
            return self.score(node, alive)
        if items_down:
            alive, item_level = np.concatenate([2 * alive, 2 * alive + 1]), item_level + 1
        nodes = [2 * node, 2 * node + 1] if docs_down else [node]
        doc_level += docs_down
        below = [(self.bounds(doc_level, m, item_level, alive), m) for m in nodes]
        for b, m in sorted(below, key=lambda x: -x[0].sum()):          # the likelier half first raises the bar
            self.visit(doc_level, m, item_level, alive, b)

    def score(self, node: int, alive: np.ndarray) -> None:
        ptr, idx, val = self.docs.levels[-1]
        terms = idx[ptr[node]:ptr[node + 1]]
        self.z[terms], self.local[terms] = val[ptr[node]:ptr[node + 1]], np.arange(len(terms))
        rows, _ = _ranges(self.items.edges[-1], alive)
        ptr, idx, val = self.items.rows
        place, begin = _ranges(ptr, rows)
        bound = np.add.reduceat(val[place] * self.z[idx[place]], begin)
        rows = rows[bound >= self.best.bar[self.items.order[rows]]]
        if len(rows):
            place, begin = _ranges(ptr, rows)
            size = np.diff(np.append(begin, len(place)))
            column = self.local[idx[place]]
            hit = column >= 0
            left = np.zeros((len(rows), len(terms)), val.dtype)
            left[np.repeat(np.arange(len(rows)), size)[hit], column[hit]] = val[place][hit]
            start, end = self.docs.edges[-1][node:node + 2]
            ptr, idx, val = self.docs.rows
            right = np.zeros((len(terms), end - start), val.dtype)
            span = slice(ptr[start], ptr[end])
            right[self.local[idx[span]], np.repeat(np.arange(end - start), np.diff(ptr[start:end + 1]))] = val[span]
            found, items = (left @ right).astype(np.int64), self.items.order[rows]
            self.scored += found.size
            ids, null, best = self.ids[start:end], self.null[start:end], self.best
            bar, last = best.bar[items, None], best.id[items, -1:]
            good = (found > bar) | (found == bar) & (null | best.null[items, -1:] | (ids <= last) |
                                                     (best.score[items, -1:] < bar))
            for r in np.flatnonzero(good.any(axis=1)):
                best.add(items[r], found[r, good[r]], ids[good[r]], null[good[r]])
        self.z[terms], self.local[terms] = 0, -1


class Items:
    """A batch of items with its tree."""

    def __init__(self, rows: list):
        self.keys = np.array([r["_item"] for r in rows], np.int64)
        sizes = [len(r["terms"]) for r in rows]
        flat = pa.array([t for r in rows for t in r["terms"]], pa.binary()).dictionary_encode()
        weights = np.array([w for r in rows for w in r["weights"]], np.int64)
        self.vocabulary = flat.dictionary
        ptr = np.concatenate([[0], np.cumsum(sizes)])
        idx = flat.indices.to_numpy().astype(np.int64)
        # doubles hold every sum exactly while all weights together stay below 2^53 / 10^6
        top = np.zeros(len(self.vocabulary), np.int64)
        np.maximum.at(top, idx, weights)
        self.kind = np.float64 if int(top.sum()) * 1_000_000 < 1 << 53 else np.int64
        self.tree = Tree(ptr, idx, weights.astype(self.kind), len(self.vocabulary), ITEM_LEAF)


_BATCH: dict[str, Items] = {}


def _batch(shared) -> Items:
    name, rows = shared.value
    if name not in _BATCH:
        _BATCH.clear()
        _BATCH[name] = Items(rows)
    return _BATCH[name]


def impacts(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L."""
    if int(n.max(initial=0)) * 50 * total_docs < 1 << 63:
        m = 50 + 50 * n * total_docs // total_terms
    else:
        m = np.array([50 + 50 * int(x) * total_docs // total_terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _search(shared, least: np.ndarray | None, k: int, total_docs: int, total_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _batch(shared)
        best = Best(len(items.keys), k, np.ones(len(items.keys), np.int64) if least is None else least)
        held: list[tuple] = []

        def block():
            size, idx, val, ids, null = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            if len(size):
                ptr = np.concatenate([[0], np.cumsum(size)])
                Search(items.tree, Tree(ptr, idx, val, len(items.vocabulary), DOC_LEAF), ids, null, best)

        for b in batches:
            terms = b.column(2)
            offset = terms.offsets.to_numpy() - terms.offsets[0].as_py()
            idx = pc.index_in(terms.flatten(), value_set=items.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
            tf, n = b.column(3).flatten().to_numpy(), b.column(1).to_numpy()
            row = np.repeat(np.arange(len(n)), np.diff(offset))
            hit = idx >= 0                                   # others only share a slot of the filter
            row, idx = row[hit], idx[hit]
            val = impacts(tf[hit], n[row], total_docs, total_terms).astype(items.kind)
            size = np.bincount(row, minlength=len(n))
            null = np.asarray(b.column(0).is_null())
            ids = np.where(null, np.iinfo(np.int64).max, b.column(0).fill_null(0).to_numpy())
            begin = np.concatenate([[0], np.cumsum(size)])
            full = np.flatnonzero(size)
            at = 0
            while at < len(full):
                room = BLOCK_TERMS - sum(len(h[1]) for h in held)
                many = int(np.searchsorted(begin[full[at:] + 1] - begin[full[at]], room, "right"))
                many = min(max(many, 0 if held else 1), BLOCK_ROWS - sum(len(h[0]) for h in held))
                take = full[at:at + many]
                if len(take):
                    span = slice(begin[take[0]], begin[take[-1] + 1])
                    held.append((size[take], idx[span], val[span], ids[take], null[take]))
                at += len(take)
                if at < len(full):
                    block()
        if held:
            block()
        item, place = np.nonzero(best.score >= best.least[:, None])
        yield pa.RecordBatch.from_arrays(
            [pa.array(items.keys[item]), pa.array(best.score[item, place]),
             pa.array(best.id[item, place], mask=best.null[item, place])], ["_item", "score", "doc_id"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _item_batches(weighted: DataFrame) -> list[DataFrame]:
    """The items in batches of at most ITEM_BYTES and one item."""
    size = F.aggregate(F.transform("terms", lambda t: F.octet_length(t) + 24), F.lit(48).cast("long"),
                       lambda a, x: a + x)
    sized = weighted.withColumn("_bytes", size)
    total = sized.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    if total <= ITEM_BYTES:
        return [weighted] if total else []
    placed = stored(ranked(sized, ["_item"], "search-items", sums=["_bytes"])
                    .withColumn("_batch", F.floor(F.col("_before__bytes") / ITEM_BYTES)), "search-batches")
    return [placed.filter(F.col("_batch") == r["_batch"])
            for r in placed.select("_batch").distinct().orderBy("_batch").collect()]


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", seed_docs: int = SEED_DOCS) -> DataFrame:
    """The k documents of highest score above 0 for every item: item_id, rank
    (from 1), doc_id, score; equal scores by ascending doc_id, null ids last.

    Term statistics cover all documents.  Null and empty texts have no terms,
    and an item without terms found in a document gives no rows; nor does an
    empty table.  Repeated rows are ranked each, and repeated or null item ids
    have a list for each of their rows.  Other columns are ignored.  Ids of
    documents are whole numbers.  About ``seed_docs`` documents are searched
    first, which only starts the bars of the search of all of them; the result
    doesn't depend on it.  Documents aren't shuffled: a task builds the trees of
    its own blocks and passes on at most k rows per item.
    """
    spark: SparkSession = docs.sparkSession
    plain = [(F.col(f"`{c}`").alias(a)) for c, a in ((item_col, "item_id"), (item_text, "text"))]
    asked = stored(items.select(*plain).withColumn("_item", F.monotonically_increasing_id()), "search-asked")
    terms = stored(asked.select("_item", F.col("text").cast("binary").alias("text"))
                   .mapInArrow(_items, "_item long, terms array<binary>"), "search-terms")
    each = terms.select("_item", F.explode("terms").alias("term"))
    bits = spark.sparkContext.broadcast(_filter_bits(each))
    postings = stored(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                  F.col(f"`{text_col}`").cast("binary").alias("text"))
                      .mapInArrow(_postings(bits), "doc_id long, n long, terms array<binary>, tfs array<long>"),
                      "search-postings")
    total_docs, total_terms = postings.filter("n > 0").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    spread = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.ln((2.0 * total_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = stored(each.join(spread, "term").withColumn("w", weight).filter("w > 0").groupBy("_item")
                      .agg(F.collect_list(F.struct("term", "w")).alias("_t"))
                      .select("_item", F.col("_t.term").alias("terms"), F.col("_t.w").alias("weights")),
                      "search-weights")
    found = []
    for batch in _item_batches(weighted):
        rows = [r.asDict() for r in batch.select("_item", "terms", "weights").orderBy("_item").collect()]
        shared = spark.sparkContext.broadcast((f"{id(batch)}-{spark.sparkContext.applicationId}", rows))
        result = "_item long, score long, doc_id long"
        least = None
        if total_docs > seed_docs:
            some = postings.filter(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 30))
                                   < int((1 << 30) * seed_docs / total_docs))
            bars = (_top(some.mapInArrow(_search(shared, None, k, total_docs, total_terms), result), k)
                    .filter(F.col("rank") == k).select("_item", "score").collect())
            bar_of = {r["_item"]: r["score"] for r in bars}
            least = np.array([bar_of.get(r["_item"], 1) for r in rows], np.int64)
        found.append(stored(postings.mapInArrow(_search(shared, least, k, total_docs, total_terms), result),
                            "search-found"))
    if not found:
        return asked.filter("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                            F.lit(0).cast("long").alias("score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    names = sized_broadcast(asked.select("_item", "item_id"))
    return _top(out, k).join(names, "_item").select("item_id", "rank", "doc_id", "score")
