"""Language identification with bit-sliced Bloom filters of character n-grams.

The filter is one table of slots; a slot holds one bit per language, in as many
words of WORD bits as the languages need.  Looking an n-gram up in PROBES slots
and AND-ing them returns all languages of a word whose set holds it at once.  A text's hits per language, less the expected false
positives of that language's share of set bits, decide.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, utf8

SIZES = (3, 4)              # n-gram lengths in characters
SLOT_BITS, PROBES = 21, 3   # 2**21 slots, three probes
SHARE, LEAST = 0.3, 2       # an n-gram joins a language at this share of its best rate, seen twice or more
SLICE = 1 << 19             # characters that are worked on at once
ROWS = 1000                 # rows whose texts are Python strings at once
WORD = 64                   # languages of a mask word
UNKNOWN = "und"
#: Share of n-grams that a kept document's language must explain.
LEAST_KNOWN = 0.3
#: Training documents per language, chosen by a hash of the id: the documented bound of the fit.
TRAIN_DOCS = 3000


def held_out(doc_id: Column) -> Column:
    return F.crc32(utf8(F.coalesce(doc_id.cast("string"), F.lit("")))) % 4 == 2


@functools.cache
def _alphabetic() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _slices(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(letters, text number of each): lower-cased characters with every run of
    other characters, and every end of a text, as one 0; at most about SLICE at
    a time.  A longer text comes in slices that overlap by the longest n-gram
    less one."""
    held, owner, size = [], [], 0
    for k, text in enumerate(texts):
        if not text:
            continue
        codes = _codes(text)
        for at in range(0, len(codes), SLICE):
            part = codes[max(0, at - max(SIZES) + 1):at + SLICE]
            held += [np.zeros(1, np.uint32), part]
            owner += [(k, 1 + len(part))]
            size += len(part)
            if size >= SLICE:
                yield _letters(held, owner)
                held, owner, size = [], [], 0
    if held:
        yield _letters(held, owner)


def _letters(held: list, owner: list) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([*held, np.zeros(1, np.uint32)])
    of = np.repeat([k for k, _ in owner], [n for _, n in owner])
    of = np.append(of, of[-1])
    codes = np.where(_alphabetic()[codes], codes, 0)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    return codes[keep], of[keep]


def _grams(codes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(64-bit hash, text number) of the n-grams whose inner characters are all
    letters; a 0 at either end stands for a word's edge."""
    wide = codes.astype(np.uint64)
    for n in SIZES:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        inside = np.ones(m, bool)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + wide[j:j + m]
            if 0 < j < n - 1:
                inside &= codes[j:j + m] != 0
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        yield h[inside], of[1:m + 1][inside]


def _slots(h: np.ndarray) -> list[np.ndarray]:
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(j) * high) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for j in range(PROBES)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang").text:
            for codes, of in _slices(texts.tolist()):
                for h, _ in _grams(codes, of):
                    grams, n = np.unique(h, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})


class Filter:
    """The fitted filter: languages (most documents first), slot table (one row
    of slots for every WORD languages), and each language's chance of a false
    positive."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, np.atleast_2d(table)
        one = self.table.dtype.type
        fill = [((self.table[k // WORD] >> one(k % WORD)) & one(1)).mean() for k in range(len(langs))]
        self.false = np.array(fill, float) ** PROBES

    def predict(self, texts: list) -> pd.DataFrame:
        """lang_pred, score (best share of the corrected hits) and known (corrected
        hits of the best language per n-gram) of each text."""
        n = len(texts)
        hits, total = np.zeros((n, len(self.langs))), np.zeros(n)
        letter = np.zeros(n, bool)
        for codes, of in _slices(texts):
            letter[of[codes != 0]] = True
            for h, own in _grams(codes, of):
                if not len(h):
                    continue
                slots = _slots(h)
                begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                at = own[begin]
                np.add.at(total, at, np.diff(np.r_[begin, len(own)]))
                for w, word in enumerate(self.table):
                    found = functools.reduce(np.bitwise_and, (word[s] for s in slots))
                    there = int(np.bitwise_or.reduce(found))
                    for k in range(w * WORD, min((w + 1) * WORD, len(self.langs))):
                        if there >> (k % WORD) & 1:
                            bits = ((found >> word.dtype.type(k % WORD)) & word.dtype.type(1)).astype(np.int32)
                            np.add.at(hits[:, k], at, np.add.reduceat(bits, begin))
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * n, "score": np.zeros(n), "known": np.zeros(n)})
        right = np.maximum(0, (hits - total[:, None] * self.false) / np.maximum(1e-9, 1 - self.false))
        best = right.argmax(axis=1)          # ties: the language with more documents
        top, every = right[np.arange(n), best], right.sum(axis=1)
        names = np.where(letter, np.array(self.langs, object)[best], UNKNOWN)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(letter & (every > 0), top / every, 0.0)
            known = np.where(total > 0, np.minimum(1, top / total), 0.0)
        return pd.DataFrame({"lang_pred": names, "score": score, "known": known})


def _train_hash(doc_id: Column) -> Column:
    return F.xxhash64(doc_id, F.lit("train")).bitwiseAND(F.lit((1 << 63) - 1))


def _limit(rows: int, least: int, train_docs: int) -> int:
    """Largest 63-bit hash that trains, for about ``train_docs`` of a language's
    ``rows``; its ``least`` hash always does."""
    return max(least, min(1 << 63, (train_docs << 63) // rows) - 1)


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Filter:
    """Fit on ``lang`` and whole texts of the labelled documents that aren't held
    out, about ``train_docs`` of each language (all, where there are fewer),
    chosen by a hash of the id, and never none.  N-grams are counted and the slots are filled by
    Spark; the driver gets one row a language, and of every WORD languages at
    most 2**SLOT_BITS slots."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = own.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.min(_train_hash(F.col("doc_id"))).alias("least")
                                    ).orderBy(F.desc("rows"), "lang").collect()
    langs = [r["lang"] for r in sizes]
    kind = np.uint8 if len(langs) <= 8 else np.uint16 if len(langs) <= 16 else np.uint64
    table = np.zeros((max(1, -(-len(langs) // WORD)), 1 << SLOT_BITS), kind)
    if not langs:
        return Filter(langs, table)
    about = docs.sparkSession.createDataFrame(
        [(r["lang"], k, _limit(r["rows"], r["least"], train_docs)) for k, r in enumerate(sizes)],
        "lang string, k int, limit long")
    chosen = own.select("doc_id", "lang", "text").join(F.broadcast(about), "lang").filter(
        _train_hash(F.col("doc_id")) <= F.col("limit"))
    counts = chosen.select("lang", "text").mapInPandas(_count, "lang string, gram long, n long")
    counts = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").cast("double").alias("every")).join(F.broadcast(about), "lang")
    rates = counts.filter(F.col("n") >= LEAST).join(F.broadcast(totals), "lang").select(
        "gram", F.struct((F.col("n") / F.col("every")).alias("rate"), "k").alias("x"))
    sets = rates.groupBy("gram").agg(F.collect_list("x").alias("xs"))      # at most one entry a language
    top = F.array_max(F.transform("xs", lambda x: x["rate"]))
    members = sets.withColumn("top", top).select(
        "gram", F.explode(F.filter("xs", lambda x: x["rate"] >= SHARE * F.col("top"))["k"]).alias("k"))
    low = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1).cast("long"))
    probes = F.explode(F.array(*[(low + F.lit(j) * high).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for j in range(PROBES)]))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k") % WORD)
    slots = members.select(probes.alias("slot"), F.floor(F.col("k") / WORD).alias("word"), bit.alias("bit")).groupBy(
        "slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas()
    table[slots["word"].to_numpy(np.int64), slots.slot.to_numpy(np.int64)] = (
        slots["mask"].to_numpy(np.int64).view(np.uint64).astype(kind))
    return Filter(langs, table)


def predict(spark: SparkSession, docs: DataFrame, model: Filter, keep: list[str] = ("doc_id",),
            text: str = "text") -> DataFrame:
    """``keep`` columns of every row with lang_pred, score and known, from the text alone."""
    shared = spark.sparkContext.broadcast(model)
    own = [*keep] if text in keep else [*keep, text]
    place = own.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                got = shared.value.predict(batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(keep)], pa.array(got.lang_pred, pa.string()), pa.array(got.score),
                     pa.array(got.known)], names=[*keep, "lang_pred", "score", "known"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())])
    return docs.select(*own).mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and known of every document.

    ``und`` (score 0) is for a null text and one without a letter, and for all
    where no labelled document can be learned from.  A text of letters whose
    n-grams are all unknown gets the language with the most documents, score 0.
    Repeated rows get one row each; an empty table gives none.
    """
    out = predict(docs.sparkSession, docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known")


def keep_known(docs: DataFrame, least_known: float = LEAST_KNOWN) -> DataFrame:
    """``docs`` without the documents that no learned language explains: those
    without a letter, and those of whose n-grams less than ``least_known`` are
    the best language's.  Columns stay as they were; where nothing can be
    learned, nothing is rejected."""
    model = fit(docs)
    if not model.langs:
        return docs
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])        # names may clash with the result's
    judged = predict(docs.sparkSession, plain, model, plain.columns, f"c{docs.columns.index('text')}")
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("known") >= least_known))
    return kept.select(*plain.columns).toDF(*docs.columns)
