"""Header reconciliation (P3, P4) and report-type classification.

Inputs are header tables ``(file, position, header)`` and a registry table
``(name, local_name, reg_order)``.  Candidate pairs come from equi joins on
normalised text, exploded substrings or shared character bigrams — never a
cross product; only the candidate pairs are scored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from orderlake.functions._util import SPACES, strip
from orderlake.operators._common import sized_broadcast

def _nfkc(text: pd.Series) -> pd.Series:
    from unicodedata import normalize
    return text.map(lambda t: normalize("NFKC", t), na_action="ignore")


def compatible_form(c: Column) -> Column:
    """Unicode NFKC: full-width and half-width forms, circled numbers, unit signs."""
    return F.pandas_udf(_nfkc, "string")(c)


# Bracketed text of a header that doesn't count, and the characters that don't.
BRACKETED = "[（(【\\[].*?[)）】\\]]"
IGNORED = f"[{SPACES}_/-]"


def normalize_fuzzy(c: Column | str) -> Column:
    """P3 normalisation: drop bracketed text (any bracket closes any other), then
    NFKC, drop white space and ``-_/``, lower case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.regexp_replace(compatible_form(F.regexp_replace(c, BRACKETED, "")), IGNORED, ""))


def normalize_contains(c: Column | str) -> Column:
    """P4 clean-up: strip, drop CR/LF, unify full-width ``：（）``, collapse white space."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.translate(F.regexp_replace(strip(c), "[\\r\\n]", ""), "：（）", ":()")
    return strip(F.regexp_replace(t, f"[{SPACES}]+", " "))


def ratio_udf(threshold: float):
    """Pandas UDF: difflib ratio of candidate pairs, exact above ``threshold``.

    One matcher per distinct right-hand string (difflib indexes the second
    sequence once); pairs are pre-sorted by it.  The cheap upper bounds
    ``real_quick_ratio`` and ``quick_ratio`` skip the full ratio when it
    cannot exceed ``threshold``; such pairs get their bound (≤ threshold).
    """
    @F.pandas_udf(DoubleType())
    def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher
        out = [0.0] * len(a)
        matchers: dict = {}
        for i, (x, y) in enumerate(zip(a, b)):
            if x is None or y is None:
                continue
            m = matchers.get(y)
            if m is None:
                m = matchers[y] = SequenceMatcher(None, "", y)
            m.set_seq1(x)
            q = m.real_quick_ratio()
            if q <= threshold:
                out[i] = q
                continue
            q = m.quick_ratio()
            out[i] = q if q <= threshold else m.ratio()
        return pd.Series(out, dtype="float64")
    return sequence_ratio


def _grams(c: Column) -> Column:
    """Distinct character bigrams (unigrams for 1-char text)."""
    n = F.length(c)
    bi = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(c, i, 2))
    return F.array_distinct(bi)


def _ratio_possible(la: Column, lb: Column, min_ratio: float) -> Column:
    """difflib ratio is at most 2·min(la, lb)/(la + lb)."""
    return (F.least(la, lb) * 2.0 / (la + lb)) > min_ratio


def _bigram_tokens(c: Column) -> Column:
    """Bigrams of ``c`` with their occurrence number (``ab#1``, ``ab#2``), so
    the token-set overlap equals the bigram multiset overlap."""
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, 2))
    return F.transform(grams, lambda x, i: F.concat(
        x, F.lit("\u0001"), F.size(F.filter(F.slice(grams, 1, i), lambda y: y == x)).cast("string")))


PREFIX_FILTER_MIN_RATIO = 0.85


def _prefix_tokens(strings: DataFrame, col: str, freq: DataFrame, min_ratio: float) -> DataFrame:
    """(string, token) for the rarest ``n - τ + 1`` bigram tokens of each string.

    For a difflib ratio r > 0.85 any matching pair shares more than
    (1.5r − 1)(La + Lb) − 1 bigram tokens: matching blocks give M − b shared
    occurrences, blocks are separated by unmatched characters (b − 1 ≤ u) and
    u < (1 − r)(La + Lb).  With La + Lb > 2·La/(2 − r) this gives a per-string
    bound τ = max(1, ⌊c·L − 1⌋), c = (1.5r − 1)·2/(2 − r); two strings whose
    overlap is at least τ share one of their first n − τ + 1 tokens in any
    fixed global order (prefix filtering).  Rare tokens first keeps it selective.
    """
    c = (1.5 * min_ratio - 1) * 2 / (2 - min_ratio)
    toks = strings.select(col, F.explode(_bigram_tokens(F.col(col))).alias("__t"))
    ranked = toks.join(freq, "__t").groupBy(col).agg(F.array_sort(F.collect_list(F.struct("__f", "__t"))).alias("__a"))
    n = F.length(col) - 1
    tau = F.greatest(F.lit(1), F.floor(F.length(col) * c - 1).cast("int"))
    return ranked.select(col, F.explode(F.slice("__a", 1, n - tau + 1)).alias("__e")).select(col, F.col("__e.__t").alias("__t"))


def _bigram_pairs(hs: DataFrame, rs: DataFrame, min_ratio: float, tasks: int) -> DataFrame:
    """Pairs that share a prefix bigram token and may have a ratio above
    ``min_ratio`` by their lengths and by the characters they lack, which is
    looked at in the join: most pairs go no further."""
    hs, rs = hs.filter(F.length("__s") >= 2), rs.filter(F.length("__s") >= 2)       # one character has none
    freq = (hs.unionByName(rs).distinct().select(F.explode(_bigram_tokens(F.col("__s"))).alias("__t"))
            .groupBy("__t").agg(F.count(F.lit(1)).alias("__f")).checkpoint(eager=True))
    hp, rp = (_prefix_tokens(x, "__s", freq, min_ratio).groupBy("__s").agg(F.collect_list("__t").alias("__ts"))
              .select(F.col("__s").alias(n + "n"), F.length("__s").alias(n + "l"), _char_bits(F.col("__s")).alias(n + "b"), "__ts")
              for x, n in ((hs, "__h"), (rs, "__r")))
    # few bytes and many pairs: a fixed number of pieces by text, each beside the registry where that is small
    hp = hp.repartition(4 * tasks, "__hn").withColumn("__t", F.explode("__ts")).drop("__ts")
    rp = rp.withColumn("__t", F.explode("__ts")).drop("__ts")
    la, lb = F.col("__hl"), F.col("__rl")
    need = (la + lb) * (min_ratio / 2) - 1e-9
    return (hp.join(sized_broadcast(rp), "__t").filter(F.col("__hn") != F.col("__rn"))
            .filter(_ratio_possible(la, lb, min_ratio))
            .filter((la - _missing("__hb", "__rb") > need) & (lb - _missing("__rb", "__hb") > need))
            .select("__hn", "__rn").distinct())


def _char_bits(c: Column) -> Column:
    """64 bits, of which each character token of ``c`` sets one."""
    return F.aggregate(_char_tokens(c), F.lit(0).cast("bigint"), lambda bits, t: bits.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))


def _missing(a: str, b: str) -> Column:
    """Bits of ``a`` that ``b`` hasn't: each stands for a character of the one
    text, or more, that the other lacks, so the character overlap (which no
    difflib ratio exceeds) is at most the length less this."""
    return F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b))))


def _char_tokens(c: Column) -> Column:
    """Characters of ``c`` with their occurrence number, so that the token-set
    overlap equals the character multiset overlap."""
    chars = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, 1))
    return F.transform(chars, lambda x, i: F.concat(
        x, F.lit("\u0001"), F.size(F.filter(F.slice(chars, 1, i), lambda y: y == x)).cast("string")))


def _char_prefix(strings: DataFrame, freq: DataFrame, min_ratio: float) -> DataFrame:
    """(__s, __all, __t, __p): the rarest character tokens of each string, with
    their place among all of them.

    A difflib ratio 2M / (La + Lb) counts M characters in matching blocks, and M
    is at most the overlap of the character multisets.  So a ratio above r needs
    an overlap above r (La + Lb) / 2, and as Lb >= La r / (2 - r), one above
    La r / (2 - r): pairs share one of the first La - that + 1 tokens.  This
    holds for any r; it is weaker than the bigram bound where that one holds.
    """
    toks = strings.select("__s", F.explode(_char_tokens(F.col("__s"))).alias("__t"))
    ranked = toks.join(freq, "__t").groupBy("__s").agg(F.array_sort(F.collect_list(F.struct("__f", "__t"))).alias("__a"))
    n = F.length("__s")
    need = F.greatest(F.lit(1), F.floor(n * (min_ratio / (2 - min_ratio)) - 1e-9).cast("int"))
    return ranked.select("__s", F.col("__a.__t").alias("__all"), F.posexplode(F.slice("__a", 1, n - need + 1)).alias("__p", "__e")) \
        .select("__s", "__all", F.col("__e.__t").alias("__t"), "__p")


def _char_pairs(hs: DataFrame, rs: DataFrame, min_ratio: float) -> DataFrame:
    """Pairs whose character overlap allows a ratio above ``min_ratio``: by
    prefix tokens, length, place of the first shared token, then the overlap itself."""
    freq = (hs.unionByName(rs).distinct().select(F.explode(_char_tokens(F.col("__s"))).alias("__t"))
            .groupBy("__t").agg(F.count(F.lit(1)).alias("__f")).checkpoint(eager=True))
    h = _char_prefix(hs, freq, min_ratio).select(F.col("__s").alias("__hn"), F.col("__all").alias("__ha"), "__t", F.col("__p").alias("__hp"))
    r = _char_prefix(rs, freq, min_ratio).select(F.col("__s").alias("__rn"), F.col("__all").alias("__ra"), "__t", F.col("__p").alias("__rp"))
    la, lb = F.length("__hn"), F.length("__rn")
    need = (la + lb) * (min_ratio / 2) - 1e-9
    near = (h.join(r, "__t").filter(_ratio_possible(la, lb, min_ratio) & (F.col("__hn") != F.col("__rn")))
            .groupBy("__hn", "__rn").agg(F.min("__hp").alias("__hp"), F.min("__rp").alias("__rp"),
                                         F.first("__ha").alias("__ha"), F.first("__ra").alias("__ra")))
    return (near.filter(F.least(la - F.col("__hp"), lb - F.col("__rp")) > need)      # tokens from the first shared one on
            .filter(F.size(F.array_intersect("__ha", "__ra")) > need).select("__hn", "__rn"))


def _dealt(pairs: DataFrame, tasks: int) -> DataFrame:
    """Pairs in partitions of about equal scoring cost (product of the lengths);
    the pairs of one header are together, in as many pieces as their cost asks for."""
    pairs = pairs.withColumn("__c", (F.length("__hn") * F.length("__rn")).cast("long")).checkpoint(eager=True)
    share = (pairs.agg(F.sum("__c")).first()[0] or 0) / (4 * tasks) + 1
    cost = pairs.groupBy("__hn").agg(F.ceil(F.sum("__c") / share).cast("int").alias("__pieces"))
    return (pairs.join(cost, "__hn").withColumn("__piece", F.pmod(F.xxhash64("__rn"), F.col("__pieces")))
            .repartition(4 * tasks, "__hn", "__piece").sortWithinPartitions("__hn").select("__hn", "__rn"))


def match_fuzzy(headers: DataFrame, registry: DataFrame, min_ratio: float = 0.85) -> DataFrame:
    """Per file and registry field the header with the same normalised text,
    else the one with the best difflib ratio above ``min_ratio`` (the field's
    text first; ties: the header that comes first).  Headers of a file with the
    same normalised text count once; the last of them is taken.  Returns (file,
    name, position, header, score, how); fields without a header are absent.

    Candidate pairs come from an equi join on *prefix* tokens of distinct
    normalised strings, then the bounds by length and by characters; only those
    pairs reach the difflib UDF, dealt to tasks by their cost.  The tokens are bigrams for ratios of 0.85
    and more (see ``_prefix_tokens``); below, where that bound doesn't hold, they
    are characters (see ``_char_prefix``), and the characters' overlap is
    compared before scoring.
    """
    if not 0 < min_ratio < 1:
        raise ValueError("min_ratio lies between 0 and 1")
    tasks = int(headers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = headers.select("header").distinct().withColumn("__hn", normalize_fuzzy("header"))
    h = (headers.join(texts, "header").groupBy("file", "__hn")
         .agg(F.min("position").alias("__first"), F.max(F.struct("position", "header")).alias("__h"))
         .select("file", "__hn", "__first", "__h.position", "__h.header").checkpoint(eager=True))
    r = registry.select("name", "reg_order", normalize_fuzzy("local_name").alias("__rn")).checkpoint(eager=True)
    exact = (h.join(r, h["__hn"] == r["__rn"]).groupBy("file", "name")
             .agg(F.min(F.struct("reg_order", "position", "header")).alias("__e"))          # one entry a name
             .select("file", "name", "__e.position", "__e.header", F.lit(1.0).alias("score"), F.lit("exact").alias("how")))
    hs = h.select(F.col("__hn").alias("__s")).distinct().filter(F.length("__s") >= 1)
    rs = r.select(F.col("__rn").alias("__s")).distinct().filter(F.length("__s") >= 1)
    pairs = _bigram_pairs(hs, rs, min_ratio, tasks) if min_ratio >= PREFIX_FILTER_MIN_RATIO else _char_pairs(hs, rs, min_ratio)
    pairs = _dealt(pairs, tasks)
    scored = pairs.withColumn("score", ratio_udf(min_ratio)("__rn", "__hn")).filter(F.col("score") > min_ratio)
    near = (scored.join(r, "__rn").select("__hn", "name", "score").join(h, "__hn")
            .join(exact.select("file", "name"), ["file", "name"], "left_anti"))
    best = Window.partitionBy("file", "name").orderBy(F.col("score").desc(), "__first")
    fuzzy = (near.withColumn("__k", F.row_number().over(best)).filter("__k = 1")
             .select("file", "name", "position", "header", "score", F.lit("fuzzy").alias("how")))
    return exact.unionByName(fuzzy)


def match_contains(headers: DataFrame, registry: DataFrame, min_len: int = 5,
                   min_len_ratio: float = 0.7) -> DataFrame:
    """The header text, then its cleaned text, as a registry entry's text;
    else the first registry entry whose cleaned text is the same or contains or
    is contained in it (both longer than ``min_len`` and length ratio above
    ``min_len_ratio``).  Matching runs once per distinct header text;
    containment pairs come from exploding substrings of the allowed lengths
    and equi-joining them, then the best match is joined back to every
    (file, position)."""
    h = headers.withColumn("__hc", normalize_contains("header"))
    hd = h.select("header", "__hc").distinct()
    r = registry.withColumn("__rc", normalize_contains("local_name"))
    e1 = hd.join(r.select("name", "reg_order", F.col("local_name").alias("__x")), hd["header"] == F.col("__x")) \
        .select("header", "name", "reg_order", F.lit(1).alias("stage"))
    e2 = hd.join(r.select("name", "reg_order", F.col("local_name").alias("__x")), hd["__hc"] == F.col("__x")) \
        .select("header", "name", "reg_order", F.lit(2).alias("stage"))
    e3 = hd.join(r.select("name", "reg_order", F.col("__rc").alias("__x")), hd["__hc"] == F.col("__x")) \
        .select("header", "name", "reg_order")

    def subs(df: DataFrame, col: str, key: Sequence[str]) -> DataFrame:
        n = F.length(F.col(col))
        lo = F.greatest(F.lit(min_len + 1), F.floor(n * min_len_ratio).cast("int") + 1)
        return (df.filter(n > min_len)
                .select(*key, col, F.explode(F.sequence(lo, n)).alias("__l"))
                .select(*key, col, "__l", F.explode(F.sequence(F.lit(1), F.length(col) - F.col("__l") + 1)).alias("__s"))
                .select(*key, col, F.expr(f"substring({col}, __s, __l)").alias("__sub")).distinct())

    ratio_ok = (F.least(F.length("__hc"), F.length("__rc")) / F.greatest(F.length("__hc"), F.length("__rc"))) > min_len_ratio
    hs = subs(hd, "__hc", ["header"])
    c1 = hs.join(r.filter(F.length("__rc") > min_len), hs["__sub"] == r["__rc"]).filter(ratio_ok) \
        .select("header", "name", "reg_order")
    rs = subs(r, "__rc", ["name", "reg_order"])
    hh = hd.filter(F.length("__hc") > min_len)
    c2 = rs.join(hh, rs["__sub"] == hh["__hc"]).filter(ratio_ok).select("header", "name", "reg_order")
    c = e3.unionByName(c1).unionByName(c2).distinct().withColumn("stage", F.lit(3))
    best = (e1.unionByName(e2).unionByName(c).groupBy("header")
            .agg(F.min_by(F.struct("name", "stage"), F.struct("stage", "reg_order")).alias("m"))
            .select("header", F.col("m.name").alias("name"), F.col("m.stage").cast("bigint").alias("stage")))
    return h.join(best, "header").select("file", "position", "header", "name", "stage")


def classify_reports(headers: DataFrame, rules: Mapping[str, Sequence[str]],
                     keywords: Mapping[str, str] | None = None, min_hits: int = 6,
                     first_n: int = 8, default: str = "unknown") -> DataFrame:
    """Report type per file: a filename keyword first, else the first rule
    with at least ``min_hits`` indicator headers among the first ``first_n``
    headers (or among all headers).  ``headers`` is (file, header_list array)."""
    t = None
    for kw, typ in (keywords or {}).items():
        cond = F.col("file").contains(kw)
        t = F.when(cond, F.lit(typ)) if t is None else t.when(cond, F.lit(typ))
    for typ, ind in rules.items():
        arr = F.array(*[F.lit(x) for x in ind])
        first = F.size(F.array_intersect(F.slice("header_list", 1, first_n), arr)) >= min_hits
        t = F.when(first, F.lit(typ)) if t is None else t.when(first, F.lit(typ))
    for typ, ind in rules.items():
        arr = F.array(*[F.lit(x) for x in ind])
        anyh = F.size(F.array_intersect(F.col("header_list"), arr)) >= min_hits
        t = t.when(anyh, F.lit(typ))
    return headers.withColumn("report_type", t.otherwise(F.lit(default)))
