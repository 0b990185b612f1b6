"""Enrichment from master data (J4-J11, J13) and match rates (A4).

Dimensions are de-duplicated on their key (last entry wins, as a dict
overwrite would) and broadcast only behind a bounded row-count check
(``sized_broadcast``); larger masters fall back to a shuffle join, where AQE
splits hot fact keys.  Lookups run on *distinct* codes first and join the
small code→key map back, so per-row work never multiplies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.text import clean_code
from orderlake.functions._util import is_blank, strip
from orderlake.operators._common import BROADCAST_BYTES, as_list, proven_small, sized_broadcast
from orderlake.operators.dedupe import keep_last

DEFAULT_BROADCAST_ROWS = 2_000_000


def _dim(dim: DataFrame, key: str, cols: Sequence[str], position: str | None,
         max_rows: int | None) -> DataFrame:
    d = dim.select(key, *[c for c in cols if c != key], *([position] if position and position not in cols else []))
    d = keep_last(d, key, position) if position else keep_last(d, key, [])
    d = d.filter(~is_blank(key))
    # de-duplication only removes rows: the raw columns bound the size
    return sized_broadcast(d, max_rows, bound_by=dim.select(*d.columns)) if max_rows else d


def overwrite(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str], dim_key: str | None = None,
              position: str | None = None, max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Matched rows take the master's value for each of ``cols`` when the
    master has it (non-NULL); otherwise the row keeps its own value."""
    dk = dim_key or on
    d = _dim(dim, dk, cols, position, max_rows)
    d = d.select(F.col(dk).alias("__dk"), *[F.col(c).alias(f"__m_{c}") for c in cols])
    j = df.join(d, df[on] == d["__dk"], "left")
    for c in cols:
        own = F.col(c) if c in df.columns else F.lit(None)
        j = j.withColumn(c, F.coalesce(F.col(f"__m_{c}"), own))
    return j.drop("__dk", *[f"__m_{c}" for c in cols])


def fill(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str], dim_key: str | None = None,
         prefix: str = "", position: str | None = None, flag: str | None = None,
         max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add master columns (``prefix`` + name); unmatched or NULL -> ''.

    ``flag`` names an optional boolean "matched" column (for A4).
    """
    dk = dim_key or on
    d = _dim(dim, dk, cols, position, max_rows)
    d = d.select(F.col(dk).alias("__dk"), F.lit(True).alias("__hit"),
                 *[F.col(c).alias(f"__m_{c}") for c in cols])
    j = df.join(d, df[on] == d["__dk"], "left")
    for c in cols:
        v = F.col(f"__m_{c}").cast("string")
        j = j.withColumn(prefix + c, F.when(F.lower(v) == "nan", F.lit("")).otherwise(F.coalesce(v, F.lit(""))))
    if flag:
        j = j.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
    return j.drop("__dk", "__hit", *[f"__m_{c}" for c in cols])


def prefer_longer(own: Column | str, master: Column | str) -> Column:
    """Master name replaces own iff master is non-empty and own is empty
    or master is longer."""
    o = F.col(own) if isinstance(own, str) else own
    m = F.col(master) if isinstance(master, str) else master
    m_ok = m.isNotNull() & (strip(m) != "")
    o_empty = o.isNull() | (strip(o) == "")
    return F.when(m_ok & (o_empty | (F.length(m) > F.length(o))), m).otherwise(o)


def casefold_key(c: Column | str) -> Column:
    """Join key normalisation: lower case, no white space at either end."""
    return F.lower(strip(c))


def casefold_join(df: DataFrame, dim: DataFrame, on: str, dim_key: str, cols: Sequence[str],
                  position: str, prefix: str = "shop_",
                  max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join on ``lower(trim(key))``; the last master row per
    normalised key wins; master columns get ``prefix`` (``shop_shop_id``)."""
    d = dim.select(casefold_key(dim_key).alias("__ck"), position, *cols)
    d = keep_last(d, "__ck", position).filter(F.col("__ck").isNotNull() & (F.col("__ck") != ""))
    d = d.select("__ck", *[F.col(c).alias(prefix + c) for c in cols])
    d = sized_broadcast(d, max_rows, bound_by=dim.select(dim_key, *cols)) if max_rows else d
    return df.join(d, casefold_key(on) == d["__ck"], "left").drop("__ck")


def attach_single(df: DataFrame, dim: DataFrame, where: Column, cols: Sequence[str],
                  defaults: dict | None = None, prefix: str = "") -> DataFrame:
    """Find the one master row matching ``where`` and stamp its columns on
    every row as literals; ``defaults`` when no master row matches.  Exactly
    one row (``limit(1)`` after a total order) reaches the driver."""
    hit = dim.filter(where).select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(1).collect()
    values = hit[0].asDict() if hit else {}
    types = dict(dim.select(*cols).dtypes)
    out = df
    for c in cols:
        v = values.get(c, (defaults or {}).get(c))
        out = out.withColumn(prefix + c, F.lit(v).cast(types[c]))
    return out


def lookup_multi(df: DataFrame, dim: DataFrame, dim_key: str, key_cols: Sequence[str],
                 out: str = "matched_key", max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Try ``key_cols`` in order; the first whose cleaned value exists in
    the master wins (``out`` = that master key, NULL if none).

    With a master key set proven small enough to broadcast, each column is a
    broadcast lookup (no shuffle of the fact table).  Otherwise the distinct
    code tuples are exploded with their priority, equi-joined once with the
    keys, reduced to the first hit per tuple, and joined back to the facts in
    a single (null-safe) shuffle join.
    """
    keys = dim.select(clean_code(dim_key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    small = bool(max_rows) and proven_small(dim.select(dim_key), max_rows, BROADCAST_BYTES // max(1, len(key_cols)))
    cleaned = [clean_code(c) for c in key_cols]
    if small:                                       # one broadcast per code column
        keys = F.broadcast(keys)
        j = df
        for i, c in enumerate(cleaned):
            kk = keys.select(F.col("__k").alias(f"__k{i}"))
            j = j.join(kk, c == kk[f"__k{i}"], "left")
        return j.withColumn(out, F.coalesce(*[F.col(f"__k{i}") for i in range(len(key_cols))])) \
            .drop(*[f"__k{i}" for i in range(len(key_cols))])
    t = [f"__t{i}" for i in range(len(key_cols))]
    tuples = df.select(*[c.alias(n) for c, n in zip(cleaned, t)]).distinct()
    cand = tuples.select(*t, F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.col(n).alias("c"))
                                                 for i, n in enumerate(t)])).alias("e")) \
        .select(*t, "e.p", "e.c").filter(F.col("c").isNotNull())
    hit = cand.join(keys, cand["c"] == keys["__k"]).groupBy(*t).agg(F.min_by("c", "p").alias(out))
    j = df.select("*", *[c.alias(n) for c, n in zip(cleaned, t)])
    cond = None
    for n in t:
        c = j[n].eqNullSafe(hit[n])
        cond = c if cond is None else cond & c
    return j.join(hit, cond, "left").drop(*[j[n] for n in t]).drop(*t)


# ------------------------------------------------------- cascading lookup J8/J9

def _cascade_candidates(code: Column) -> Column:
    """Candidate keys with their priority, in the order the cascade tries them.

    1 exact; 2 left-pad 15; 3 right-pad 15; 4 left-pad 14 then right-pad 15;
    5 leading zeros removed; then for L = 10..15: left-pad L, right-pad L.
    Padding applies only to codes shorter than the target width.
    """
    n = F.length(code)
    cands = [F.struct(F.lit(1).alias("prio"), code.alias("cand"))]
    short15 = n < 15
    cands.append(F.struct(F.lit(2).alias("prio"), F.when(short15, F.lpad(code, 15, "0")).alias("cand")))
    cands.append(F.struct(F.lit(3).alias("prio"), F.when(short15, F.rpad(code, 15, "0")).alias("cand")))
    lp14 = F.when(n < 14, F.lpad(code, 14, "0")).otherwise(code)
    cands.append(F.struct(F.lit(4).alias("prio"),
                          F.when(short15, F.when(F.length(lp14) < 15, F.rpad(lp14, 15, "0")).otherwise(lp14))
                          .alias("cand")))
    stripped = F.regexp_replace(code, "^0+", "")
    cands.append(F.struct(F.lit(5).alias("prio"),
                          F.when((stripped != "") & (stripped != code), stripped).alias("cand")))
    for i, width in enumerate(range(10, 16)):
        shorter = n < width
        cands.append(F.struct(F.lit(6 + 2 * i).alias("prio"), F.when(shorter, F.lpad(code, width, "0")).alias("cand")))
        cands.append(F.struct(F.lit(7 + 2 * i).alias("prio"), F.when(shorter, F.rpad(code, width, "0")).alias("cand")))
    return F.array(*cands)


PREFIX_STAGE = 18
MIN_PREFIX_LEN = 8


def lookup_cascade(df: DataFrame, dim: DataFrame, code: str, dim_key: str, position: str,
                   out: str = "matched_key", stage: str = "match_stage") -> DataFrame:
    """J8 + J9 + J13: resolve a free-text product code to a master key.

    Runs on distinct cleaned codes: padded/stripped candidates are exploded and
    equi-joined with the master keys (lowest priority wins); codes still
    unmatched and at least 8 characters long then take the first master key
    (by ``position``) such that one is a prefix of the other.  Prefix pairs
    come from two equi joins on exploded prefixes — the code's prefixes against
    master keys, and the master keys' prefixes (pre-reduced to the first key
    per prefix) against codes — never from a cross join.
    """
    master = (dim.select(clean_code(dim_key).alias("__key"), F.col(position).alias("__pos"))
              .filter(F.col("__key").isNotNull())
              .groupBy("__key").agg(F.min("__pos").alias("__pos")))
    # distinct codes and the exact-stage map feed several branches below;
    # checkpointing them (shared checkpoint folder) computes each once and
    # cuts lineage, instead of re-running the fact scan per branch.
    codes = df.select(clean_code(code).alias("__code")).filter(F.col("__code").isNotNull()).distinct() \
        .checkpoint(eager=True)

    cand = codes.select("__code", F.explode(_cascade_candidates(F.col("__code"))).alias("c")) \
        .select("__code", "c.prio", "c.cand").filter(F.col("cand").isNotNull())
    hit = cand.join(master, cand["cand"] == master["__key"], "inner")
    exact = hit.groupBy("__code").agg(F.min_by(F.struct("prio", "cand"), "prio").alias("m")) \
        .select("__code", F.col("m.cand").alias("__mkey"), F.col("m.prio").alias("__stage")) \
        .checkpoint(eager=True)

    rest = codes.join(exact, "__code", "left_anti").filter(F.length("__code") >= MIN_PREFIX_LEN)
    # master key is a prefix of the code
    # only prefixes as long as some key (some code) can match
    key_lo, key_hi = master.agg(F.min(F.length("__key")), F.max(F.length("__key"))).first()
    code_hi = rest.agg(F.max(F.length("__code"))).first()[0] or 0
    key_lo, key_hi = key_lo or 1, key_hi or 0
    code_pref = rest.filter(F.length("__code") >= key_lo).filter(F.lit(key_hi) >= key_lo) \
        .select("__code", F.explode(F.sequence(F.lit(key_lo), F.least(F.length("__code"), F.lit(key_hi)))).alias("__l")) \
        .select("__code", F.expr("substring(__code, 1, __l)").alias("__p"))
    a = code_pref.join(master, code_pref["__p"] == master["__key"], "inner").select("__code", "__key", "__pos")
    # the code is a prefix of a master key: first key per prefix, then join
    mk = master.filter(F.length("__key") >= MIN_PREFIX_LEN)
    key_pref = mk.filter(F.lit(code_hi) >= MIN_PREFIX_LEN) \
        .select("__key", "__pos", F.explode(F.sequence(F.lit(MIN_PREFIX_LEN), F.least(F.length("__key"), F.lit(code_hi))))
                .alias("__l")) \
        .select(F.expr("substring(__key, 1, __l)").alias("__p"), "__key", "__pos") \
        .groupBy("__p").agg(F.min_by(F.struct("__key", "__pos"), "__pos").alias("m")) \
        .select("__p", F.col("m.__key").alias("__key"), F.col("m.__pos").alias("__pos"))
    b = rest.join(key_pref, rest["__code"] == key_pref["__p"], "inner").select("__code", "__key", "__pos")
    pref = a.unionByName(b).groupBy("__code").agg(F.min_by("__key", F.struct("__pos", "__key")).alias("__mkey")) \
        .withColumn("__stage", F.lit(PREFIX_STAGE))

    resolved = exact.unionByName(pref)
    j = df.withColumn("__code", clean_code(code)).join(resolved, "__code", "left")
    return j.withColumnRenamed("__mkey", out).withColumnRenamed("__stage", stage).drop("__code")


def match_rate(df: DataFrame, matched: Column | str, by=None) -> DataFrame:
    """A4: matched / unmatched rows and matched % (overall or per group)."""
    m = F.col(matched) if isinstance(matched, str) else matched
    by = as_list(by)
    g = df.groupBy(*by) if by else df.groupBy()
    out = g.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                F.count_if(F.coalesce(m, F.lit(False))).cast("bigint").alias("matched"))
    out = out.withColumn("unmatched", (F.col("rows") - F.col("matched")).cast("bigint"))
    pct = F.round((F.col("matched") * 100.0 / F.col("rows")).cast("decimal(20,6)"), 2).cast("decimal(6,2)")
    return out.withColumn("matched_pct", pct)
