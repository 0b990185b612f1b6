"""Upsert into an existing table (K6), source-priority union (J12) and
membership filters (F6).

All of them are unions plus keyed windows/anti joins; membership sets are
never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions._util import is_blank
from orderlake.operators._common import as_list
from orderlake.operators.dedupe import keep_best


def upsert(old: DataFrame, new: DataFrame, keys, order=None, ts: str | None = None,
           require: str | None = None) -> DataFrame:
    """K6: union old and new rows, keep one row per key.

    The newer generation wins (``new`` over ``old``); inside a generation the
    greatest ``order`` tuple wins.  With ``ts`` the latest timestamp wins first
    (missing timestamps lose), generation second.  ``require`` drops rows whose
    column is NULL or blank (F2: blank date).  ``upsert(upsert(x, y), y)`` equals
    ``upsert(x, y)``.
    """
    keys = as_list(keys)
    both = (old.withColumn("__gen", F.lit(0))
            .unionByName(new.withColumn("__gen", F.lit(1)), allowMissingColumns=True))
    spec = []
    if ts:
        spec.append((ts, False))
    spec.append(("__gen", False))
    spec += [(c, False) for c in as_list(order)]
    out = keep_best(both, keys, spec, tiebreak_ascending=False).drop("__gen")
    if require:
        out = out.filter(~is_blank(require))
    return out


def member_of(df: DataFrame, other: DataFrame, keys, negate: bool = False) -> DataFrame:
    """``isin`` / ``~isin`` against another table's keys (semi/anti join)."""
    keys = as_list(keys)
    ks = other.select(*keys).distinct()
    return df.join(ks, keys, "left_anti" if negate else "left_semi")


def priority_union(sources: Sequence[DataFrame], keys, source_col: str | None = None,
                   labels: Sequence[str] | None = None) -> DataFrame:
    """Keep every row of the first source; add rows of each lower source
    whose key is not yet present.  Distinct keys are aggregated before the
    anti join, so the right side holds one row per key."""
    keys = as_list(keys)
    out = None
    for i, src in enumerate(sources):
        if source_col:
            src = src.withColumn(source_col, F.lit(labels[i] if labels else str(i)))
        if out is None:
            out = src
        else:
            add = src.join(out.select(*keys).distinct(), keys, "left_anti")
            out = out.unionByName(add, allowMissingColumns=True)
    return out
