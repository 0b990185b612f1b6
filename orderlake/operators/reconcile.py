"""Reconciliation of two reports of the same orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators._common import as_list


def key_coverage(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Common, left-only and right-only keys with their row counts.

    Both sides are reduced to (key, rows) first (partial aggregation), so the
    full outer join sees one row per key per side.
    """
    keys = as_list(keys)
    lk = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__l"))
    rk = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__r"))
    j = lk.join(rk, keys, "full_outer")
    cls = (F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), F.lit("both"))
           .when(F.col("__l").isNotNull(), F.lit("left_only")).otherwise(F.lit("right_only")))
    return (j.groupBy(cls.alias("coverage"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_keys"),
                 F.coalesce(F.sum("__l"), F.lit(0)).cast("bigint").alias("left_rows"),
                 F.coalesce(F.sum("__r"), F.lit(0)).cast("bigint").alias("right_rows")))


def reconcile(left: DataFrame, right: DataFrame, keys, suffix: str = "_shipping",
              coalesce_cols: dict[str, tuple[str, str]] | None = None,
              provenance: str = "source", unique: str | None = None,
              null_safe: bool = True, many_keys: DataFrame | None = None) -> DataFrame:
    """Full outer join on ``keys``; right columns that collide with
    left columns get ``suffix``; keys are coalesced; ``coalesce_cols`` maps an
    output name to (left column, right column) with left winning unless it is
    NULL or blank; ``provenance`` tells which side(s) held the key.

    ``unique`` ('left' or 'right') declares a side with at most one row per
    key (an order header, or a side de-duplicated with W1).  The full outer
    join is then computed as ``many LEFT JOIN unique`` plus ``unique`` rows
    whose key never occurs on the many side (anti join against the many side's
    distinct keys).  Both joins let AQE split a hot key of the many side —
    a plain full outer join cannot be split — and the anti join's right side
    is pre-aggregated to one row per key.  ``null_safe`` matches NULL keys to
    each other (pandas ``merge`` semantics).  ``many_keys`` may supply the
    many side's key set from a cheaper source (e.g. the raw table before
    de-duplication, which has the same keys), so the many side is not
    computed twice.
    """
    keys = as_list(keys)
    lcols = set(left.columns)
    ren = {c: (c + suffix if c in lcols else c) for c in right.columns if c not in keys}
    r = right.select(*[F.col(k).alias(f"__rk_{k}") for k in keys],
                     *[F.col(c).alias(n) for c, n in ren.items()]).withColumn("__in_r", F.lit(True))
    l_ = left.withColumn("__in_l", F.lit(True))

    def cond_of(a: DataFrame, b: DataFrame):
        cond = None
        for k in keys:
            c = a[k].eqNullSafe(b[f"__rk_{k}"]) if null_safe else a[k] == b[f"__rk_{k}"]
            cond = c if cond is None else cond & c
        return cond

    if unique == "left":
        many = r.join(l_, cond_of(l_, r), "left")
        mk = (many_keys.select(*[F.col(k).alias(f"__rk_{k}") for k in keys]) if many_keys is not None
              else r.select(*[f"__rk_{k}" for k in keys])).distinct()
        only = l_.join(mk, cond_of(l_, mk), "left_anti")
        j = many.unionByName(only, allowMissingColumns=True)
    elif unique == "right":
        many = l_.join(r, cond_of(l_, r), "left")
        mk = (many_keys.select(*keys) if many_keys is not None else l_.select(*keys)).distinct()
        only = r.join(mk, cond_of(mk, r), "left_anti")
        j = many.unionByName(only, allowMissingColumns=True)
    else:
        j = l_.join(r, cond_of(l_, r), "full_outer")
    out_keys = [F.coalesce(F.col(k), F.col(f"__rk_{k}")).alias(k) for k in keys]
    rest = [c for c in left.columns if c not in keys] + list(ren.values())
    prov = (F.when(F.col("__in_l") & F.col("__in_r"), F.lit("both"))
            .when(F.col("__in_l").isNotNull(), F.lit("left_only")).otherwise(F.lit("right_only")))
    out = j.select(*out_keys, *[F.col(c) for c in rest], prov.alias(provenance))
    for name, (lc, rc) in (coalesce_cols or {}).items():
        lv, rv = F.col(lc), F.col(ren.get(rc, rc))
        out = out.withColumn(name, F.coalesce(F.when(F.trim(lv.cast("string")) != "", lv),
                                              F.when(F.trim(rv.cast("string")) != "", rv)))
    return out


def union_reports(*dfs: DataFrame, source_col: str | None = "data_source",
                  labels: Sequence[str] | None = None) -> DataFrame:
    """Union by column name (missing columns NULL) with provenance."""
    out = None
    for i, d in enumerate(dfs):
        if source_col:
            d = d.withColumn(source_col, F.lit(labels[i] if labels else str(i)))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def key_difference(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Distinct keys of ``left`` absent from ``right``."""
    keys = as_list(keys)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def key_intersection(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Distinct keys present on both sides."""
    keys = as_list(keys)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_semi")
