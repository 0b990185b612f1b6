"""URL filter: rules by host and path, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models over the bytes of host and path are
counted from all URLs that a rule accepts or rejects.  A URL without a rule is
judged by the difference of its log-likelihoods, divided by its length, against
a threshold that is calibrated on rule-judged URLs left out of the counts.

The model is a Spark table with one row for each distinct n-gram of the URLs, so
it grows with them.  An n-gram's ORDER + 1 bytes fit a long, which is its key;
shorter n-grams and all contexts are sums over the same rows, so a gram never
counts more than its context.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators._common import sized_broadcast

from .common import LOWER, UPPER, stored

#: (verdict, rule); a rule is a host suffix and a path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Longest context in bytes; bits of a hashed count table (``ratio`` alone); weight of the shorter context.
ORDER, BITS, PRIOR = 4, 16, 4.0
#: Summed weights are whole multiples of 1 / UNIT nats, so their order doesn't matter.
UNIT = float(1 << 32)
ROWS = 1000          # URLs whose n-grams leave a task at once
#: Every CALIBRATE-th rule-judged URL (by crc32 of its id) sets the threshold instead of the counts.
CALIBRATE = 5
BINS = 4000          # of the calibration histogram, each a hundredth of a nat per byte wide
TABLES = 2 * ORDER + 1   # n-grams with 0 to ORDER bytes of context, contexts of 1 to ORDER bytes


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/``, ``?``, ``#`` or
    the end with A-Z lower-cased; path from there up to ``?``, ``#`` or the end."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, both null without one."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):      # the longest is tried first
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _positions(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places, lengths): the joined bytes of all texts, each after ORDER
    bytes of padding and with an end byte; the places of all bytes but padding;
    and how many each text has."""
    lengths = []
    parts = []
    for t in texts:
        b = t.encode("utf-8", "surrogatepass")
        lengths.append(len(b) + 1)
        parts.append(b"\x01" * ORDER + b + b"\x00")
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    lengths = np.array(lengths)
    begin = np.cumsum(lengths + ORDER) - lengths
    target = np.arange(lengths.sum()) + np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
    return data, target, lengths


def _keys(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, lengths): the n-gram that ends at each position, its bytes as one
    number (the last byte lowest)."""
    data, target, lengths = _positions(texts)
    keys = np.zeros(len(target), np.uint64)
    for k in range(ORDER, -1, -1):
        keys = (keys << np.uint64(8)) | data[target - k]
    return keys.astype(np.int64), lengths


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for at in range(0, len(whole), ROWS):
            batch = whole.iloc[at:at + ROWS]
            keys, lengths = _keys(batch.text.tolist())
            yield pd.DataFrame({c: np.repeat(batch[c].to_numpy(), lengths) for c in ("row", "block", "allow")}
                               | {"gram": keys})


def spelled(rows: DataFrame) -> DataFrame:
    """One row per byte and end of each of ``rows`` (row, text, block, allow):
    row, block, allow, gram."""
    return rows.mapInPandas(_spell, "row long, block long, allow long, gram long")


def weights(grams: DataFrame, block: int, allow: int) -> DataFrame:
    """(gram, weight): what an n-gram adds to the log-likelihood difference,
    accepted minus rejected, in 1 / UNIT nats.

    ``grams`` has the exact counts (gram, block, allow) of the longest n-grams, and
    0 for those that are only to be scored; ``block`` and ``allow`` are the sums of
    the counts.  Level by level, an n-gram meets its context (at most 256 n-grams
    each) and its own end (the end of at most 256).
    """
    classes = {"block": block, "allow": allow}
    levels = [grams]
    for k in range(ORDER - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        levels.insert(0, levels[0].groupBy(shorter.alias("gram")).agg(*[F.sum(c).alias(c) for c in classes]))
    below = levels[0].select("gram", *[
        ((F.col(c) + F.lit(PRIOR / 256)) / F.lit(n + PRIOR)).alias(f"p_{c}") for c, n in classes.items()])
    for k in range(1, ORDER + 1):
        context = Window.partitionBy(F.shiftright("gram", 8))
        counted = levels[k].select("gram", F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("_end"), *classes,
                                   *[F.sum(c).over(context).alias(f"_of_{c}") for c in classes])
        below = counted.join(below.withColumnRenamed("gram", "_end"), "_end").select("gram", *[
            ((F.col(c) + F.lit(PRIOR) * F.col(f"p_{c}")) / (F.col(f"_of_{c}") + F.lit(PRIOR))).alias(f"p_{c}")
            for c in classes])
    weight = F.round((F.log("p_allow") - F.log("p_block")) * F.lit(UNIT)).cast("long")
    return below.select("gram", weight.alias("weight"))


def scores(rows: DataFrame) -> DataFrame | None:
    """(row, score): the length-normalised log-likelihood difference of each of
    ``rows`` (row, text, block, allow), accepted minus rejected; ``block`` and
    ``allow`` are 1 where a row counts for that class, else 0.  None where a class
    has no row.

    The n-grams are counted and weighted once each; the positions then look their
    weights up by a join.
    """
    grams = stored(spelled(rows).groupBy("gram").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")),
                   "url-grams")
    block, allow = grams.agg(F.sum("block"), F.sum("allow")).first()
    if not block or not allow:
        return None
    model = sized_broadcast(stored(weights(grams, block, allow), "url-weights"))
    return spelled(rows).select("row", "gram").join(model, "gram").groupBy("row").agg(
        (F.sum("weight") / F.lit(UNIT) / F.count(F.lit(1))).alias("score"))


def _hashed(texts: Sequence[str]):
    """Table slots of every position of every text and its end.

    Returns (grams, contexts, lengths): grams[k] and contexts[k] are the slots
    of the n-gram with k bytes of context and of that context alone.
    """
    data, target, lengths = _positions(texts)
    mix, spread, shift = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    context = np.zeros(len(target), np.uint64)
    grams, contexts = [], []
    for k in range(ORDER + 1):
        if k:
            power = np.uint64(pow(int(mix), k, 1 << 64))
            context = context + (data[target - k] + np.uint64(1)) * power
        contexts.append(((context * spread) >> shift).astype(np.int64))
        grams.append((((context * mix + data[target] + np.uint64(1)) * mix * spread) >> shift).astype(np.int64))
    return grams, contexts, lengths


def ratio(texts: Sequence[str], model: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood difference, accepted minus rejected, from
    hashed count tables in memory (2 classes x TABLES x 2**BITS).  Hashed n-grams
    collide, so ``judge_urls`` doesn't use it."""
    grams, contexts, lengths = _hashed(texts)
    total = np.zeros(int(lengths.sum()))
    for c, sign in ((0, -1.0), (1, 1.0)):
        p = (model[c, 0][grams[0]] + PRIOR / 256) / (model[c, 0].sum() + PRIOR)
        for k in range(1, ORDER + 1):
            p = (model[c, k][grams[k]] + PRIOR * p) / (model[c, ORDER + k][contexts[k]] + PRIOR)
        total += sign * np.log(p)
    return np.add.reduceat(total, np.cumsum(lengths) - lengths) / lengths if len(lengths) else total


def threshold(histogram: pd.DataFrame) -> float:
    """The cut (hundredths of a nat) with the best balanced accuracy on the
    calibration rows; 0 where a class has none."""
    n = {what: np.zeros(BINS + 1) for what in ("allow", "block")}
    for what, at, rows in histogram[["verdict", "bin", "n"]].itertuples(index=False):
        n[what][int(at) + BINS // 2] += rows
    if not n["allow"].sum() or not n["block"].sum():
        return 0.0
    below_block = np.concatenate([[0], np.cumsum(n["block"])]) / n["block"].sum()
    above_allow = 1 - np.concatenate([[0], np.cumsum(n["allow"])]) / n["allow"].sum()
    good = below_block + above_allow
    best = np.flatnonzero(good == good.max())
    cut = best - BINS // 2
    return float(cut[np.argmin(np.abs(cut))]) / 100


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score, threshold.

    A URL that is null or has no ``://`` has an empty host and path.  Without
    rule-judged URLs of both kinds, the ratio says nothing (score and threshold
    from one class or none); ``allow`` wins ties.  Repeated rows are judged
    alike.  An empty table gives no rows.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    held = F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")) % CALIBRATE == 0
    rows = stored(rows.select("*", rule.alias("rule"), verdict.alias("_given"), held.alias("_held"),
                              F.monotonically_increasing_id().alias("_row")), "url-rows")
    counts = lambda what: F.coalesce((F.col("_given") == what) & ~F.col("_held"), F.lit(False)).cast("long")
    judged = scores(rows.select(F.col("_row").alias("row"), F.concat("host", "path").alias("text"),
                                counts("block").alias("block"), counts("allow").alias("allow")))
    if judged is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        scored = stored(rows.join(judged.withColumnRenamed("row", "_row"), "_row"), "url-scores")
    bins = F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-BINS // 2)), F.lit(BINS // 2 - 1))
    cut = threshold(scored.filter("_held AND _given IS NOT NULL").groupBy(
        F.col("_given").alias("verdict"), bins.alias("bin")).agg(F.count(F.lit(1)).alias("n")).toPandas())
    own = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_given", own).alias("verdict"), "score",
                         F.lit(cut).alias("threshold"))
