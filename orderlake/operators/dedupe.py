"""Deterministic de-duplication (W1-W4) and duplicate statistics (A1-A3).

Keep-one-per-key is ``row_number() over (partition by key order by …) = 1``.
Spark plans it with a *partial* WindowGroupLimit before the shuffle, so each
map task forwards at most one row per key: a key holding a third of the table
is cut down map-side and never lands whole in one reduce task.

Every ordering is made total: after the caller's ordering come all remaining
columns, so the kept row never depends on file order or task scheduling.
NULL sorts as the smallest value (ascending NULLS FIRST, descending NULLS LAST).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators._common import as_list, orderable


def _sort(c, ascending: bool) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def keep_best(df: DataFrame, keys: Sequence[str] | str,
              order: Sequence[tuple[Column | str, bool]],
              tiebreak_ascending: bool = False) -> DataFrame:
    """Keep the first row per key under ``order`` — a list of
    ``(column, ascending)`` — with ties broken by every other column."""
    keys = as_list(keys)
    named = {c for c, _ in order if isinstance(c, str)}
    sort = [_sort(c, asc) for c, asc in order]
    ties = [_sort(c, tiebreak_ascending)
            for c in orderable(df, exclude=sorted(set(keys) | named))]
    w = Window.partitionBy(*keys).orderBy(*sort, *ties)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def keep_last(df: DataFrame, keys, seq) -> DataFrame:
    """The row with the greatest ``seq`` tuple per key wins."""
    return keep_best(df, keys, [(c, False) for c in as_list(seq)], tiebreak_ascending=False)


def keep_first(df: DataFrame, keys, seq) -> DataFrame:
    """The row with the smallest ``seq`` tuple per key wins."""
    return keep_best(df, keys, [(c, True) for c in as_list(seq)], tiebreak_ascending=True)


def source_rank(source: Column | str, ranks: Mapping[str, int]) -> Column:
    """Rank of a source label; unknown labels rank 0."""
    src = F.col(source) if isinstance(source, str) else source
    expr = None
    for name, r in ranks.items():
        expr = (F.when(src == name, F.lit(r)) if expr is None
                else expr.when(src == name, F.lit(r)))
    return F.lit(0) if expr is None else expr.otherwise(F.lit(0))


def keep_priority(df: DataFrame, keys, source: str, ranks: Mapping[str, int],
                  seq, rank_col: str = "source_rank", keep_rank: bool = False) -> DataFrame:
    """Highest source rank per key wins; equal ranks keep the first ``seq``."""
    out = df.withColumn(rank_col, source_rank(source, ranks))
    order = [(rank_col, False)] + [(c, True) for c in as_list(seq)]
    out = keep_best(out, keys, order, tiebreak_ascending=True)
    return out if keep_rank else out.drop(rank_col)


def keep_latest(df: DataFrame, keys, ts: str, seq=None) -> DataFrame:
    """Latest ``ts`` per key (missing ts loses), then greatest ``seq``."""
    order = [(ts, False)] + [(c, False) for c in as_list(seq)]
    return keep_best(df, keys, order, tiebreak_ascending=False)


# ---------------------------------------------------------------- statistics

def key_counts(df: DataFrame, keys) -> DataFrame:
    """Rows per key (map-side partial aggregation, so hot keys are cheap)."""
    return df.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("n"))


def duplicate_stats(df: DataFrame, keys) -> DataFrame:
    """A1: rows, distinct keys, surplus rows, repeated keys, max multiplicity."""
    kc = key_counts(df, keys)
    return kc.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.count_if(F.col("n") > 1).cast("bigint").alias("repeated_keys"),
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("max_multiplicity"),
    )


def top_duplicates(df: DataFrame, keys, n: int = 10) -> DataFrame:
    """A2: the ``n`` most repeated keys (count desc, then key asc)."""
    keys = as_list(keys)
    kc = key_counts(df, keys).filter(F.col("n") > 1)
    return (kc.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_first() for k in keys])
            .limit(n).select(*keys, F.col("n").cast("bigint").alias("n")))


def duplicates_by_source(df: DataFrame, keys, source: str) -> DataFrame:
    """A3: for every repeated key, the number of rows per source.

    Aggregates to (key, source) first; the per-key window then runs over at
    most one row per source, so it is bounded by the number of sources.
    """
    keys = as_list(keys)
    ks = df.groupBy(*keys, source).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy(*keys))
    return (ks.withColumn("__tot", tot).filter(F.col("__tot") > 1)
            .select(*keys, source, F.col("n").cast("bigint").alias("n"),
                    F.col("__tot").cast("bigint").alias("key_rows")))
