"""Data-quality metrics.

Each metric is one aggregation with map-side partial aggregation; per-column
metrics unpivot first so the work per column is a grouped aggregate rather
than a Python loop over columns with one job each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.functions._util import is_blank
from orderlake.operators._common import as_list


def require_key(df: DataFrame, keys) -> DataFrame:
    """drop rows whose key is NULL or blank (Unicode white space too)."""
    out = df
    for k in as_list(keys):
        out = out.filter(~is_blank(k))
    return out


def require_date(df: DataFrame, date: str, parsed: Column | None = None) -> DataFrame:
    """drop rows with a blank date (F2) or, given ``parsed``, a date
    that does not parse (F5)."""
    out = df.filter(~is_blank(date))
    return out.filter(parsed.isNotNull()) if parsed is not None else out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column (aggregate, never collected)."""
    return df.select(col).distinct()


def date_range(df: DataFrame, date: str) -> DataFrame:
    """A5: first and last date."""
    d = F.to_date(F.col(date))
    return df.agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"))


def order_summary(df: DataFrame, date: str, amount: Column | str, order_key: str,
                  product_key: str) -> DataFrame:
    """Row count, date range, exact Σ amount, distinct products and orders."""
    a = F.col(amount) if isinstance(amount, str) else amount
    d = F.to_date(F.col(date))
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.min(d).alias("first_date"), F.max(d).alias("last_date"),
        F.sum(a.try_cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_amount"),
        F.countDistinct(product_key).cast("bigint").alias("distinct_products"),
        F.countDistinct(order_key).cast("bigint").alias("distinct_orders"),
    )


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first (ties by value); top ``n``."""
    out = (df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
           .orderBy(F.col("n").desc(), F.col(col).asc_nulls_first()))
    return out.limit(n) if n else out


def _as_text_columns(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").cast("string").alias(c) for c in cols]


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Per column NULL count and non-NULL % (columns with NULLs only)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                                         F.col(f"n{i}").alias("null_count"))
                                for i, c in enumerate(cols)])).alias("s")
    out = agg.select("__rows", stack).select(
        "s.column", F.col("s.position").cast("bigint").alias("position"),
        F.col("s.null_count").cast("bigint").alias("null_count"),
        F.round(((F.col("__rows") - F.col("s.null_count")) * 100.0 / F.col("__rows")).cast("decimal(20,6)"), 2)
        .cast("decimal(6,2)").alias("non_null_pct"))
    return out.filter(F.col("null_count") > 0) if only_missing else out


def profile(df: DataFrame, samples: bool = True, hashed_sample: bool = True) -> DataFrame:
    """Per column type, non-NULL count, distinct count and sample values.

    Columns are unpivoted to (column, value) text pairs; samples are the
    smallest, largest and a hash-chosen value — all plain aggregates, so no
    column's values are gathered in one place.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = df.columns
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(f"`{c}`").cast("string").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.column", "kv.value")
    aggs = [F.count("value").cast("bigint").alias("non_null"),
            F.countDistinct("value").cast("bigint").alias("distinct_values")]
    if samples:
        aggs += [F.min("value").alias("sample_min"), F.max("value").alias("sample_max")]
        if hashed_sample:
            aggs.append(F.min_by("value", F.xxhash64("value")).alias("sample_hashed"))
    prof = long.groupBy("column").agg(*aggs)
    meta = df.sparkSession.createDataFrame([(c, i, types[c]) for i, c in enumerate(cols)],
                                           "column string, position int, data_type string")
    return F.broadcast(meta).join(prof, "column", "left")


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order`` (a file's place, say) with ``row``
    from 1.  Every task keeps n rows and one merges them; nothing is sorted whole."""
    top = df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
    place = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order]))       # over n rows
    return top.withColumn("row", place)


def first_values(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """Per column its cells in the first ``n`` rows by ``order``, as text:
    column, position, first_values (NULL cells stay)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("position"), F.col(f"`{c}`").cast("string").alias("value"))
                      for k, c in enumerate(df.columns)])
    long = first_rows(df, order, n).select("row", F.explode(cells).alias("c")).select("row", "c.*")
    return long.groupBy("column", "position").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "value"))),
                                                              lambda x: x["value"]).alias("first_values"))


def changed_cells(df: DataFrame, cleaned: Mapping[str, Column]) -> DataFrame:
    """Per column, number of cells whose cleaned value differs (NULL-safe),
    plus a ``*total*`` row."""
    names = list(cleaned)
    agg = df.agg(*[F.count_if(~F.col(f"`{c}`").eqNullSafe(e)).cast("bigint").alias(f"c{i}")
                   for i, (c, e) in enumerate(cleaned.items())])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("changed_cells")) for i, c in enumerate(names)]
    total = sum((F.col(f"c{i}") for i in range(len(names))), F.lit(0).cast("bigint"))
    rows.append(F.struct(F.lit("*total*").alias("column"), total.alias("changed_cells")))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.column", "r.changed_cells")


def step_counts(steps: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Rows in / out / removed and removed % for named steps, plus total."""
    parts = None
    for i, (name, before, after) in enumerate(steps):
        for side, d in (("in", before), ("out", after)):
            row = d.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("step"), F.lit(i).alias("pos"), F.lit(side).alias("side"), "n")
            parts = row if parts is None else parts.unionByName(row)
    per = parts.groupBy("step", "pos").agg(
        F.sum(F.when(F.col("side") == "in", F.col("n"))).cast("bigint").alias("rows_in"),
        F.sum(F.when(F.col("side") == "out", F.col("n"))).cast("bigint").alias("rows_out"))
    tot = per.agg(F.lit("*total*").alias("step"), F.lit(len(steps)).alias("pos"),
                  F.sum("rows_in").cast("bigint").alias("rows_in"),
                  F.sum("rows_out").cast("bigint").alias("rows_out"))
    out = per.unionByName(tot)
    return (out.withColumn("removed", (F.col("rows_in") - F.col("rows_out")).cast("bigint"))
            .withColumn("removed_pct", F.round((F.col("removed") * 100.0 / F.col("rows_in"))
                                               .cast("decimal(20,6)"), 2).cast("decimal(6,2)")))


class ObservedSteps:
    """Rows in and out of a flow's steps, counted while the flow runs once.

    ``mark`` a frame after each step, run one action on what came out of them
    (a load, say), then ask for the ``report``: the counts are metrics of that
    action, so no source is scanned for them.  A map task that is computed again
    after its executor is lost may count twice; ``step_counts`` counts by itself.
    """

    def __init__(self):
        self._marks: list[tuple[str, str | None, Observation]] = []

    def mark(self, df: DataFrame, name: str, after: str | None = None) -> DataFrame:
        """``df`` with its rows counted under ``name``; ``after`` names the mark
        whose rows went into the step (none: a source)."""
        if after is not None and after not in [n for n, _, _ in self._marks]:
            raise ValueError(f"no mark is named {after}")
        seen = Observation()
        self._marks.append((name, after, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """step, pos, rows_in, rows_out, removed and removed_pct of every step and
        in total; to be called after the action."""
        rows = {name: seen.get["rows"] for name, _, seen in self._marks}
        steps = [(name, rows[after], rows[name]) for name, after, _ in self._marks if after is not None]
        steps.append(("*total*", sum(s[1] for s in steps), sum(s[2] for s in steps)))
        out = spark.createDataFrame([(n, k, a, b, a - b) for k, (n, a, b) in enumerate(steps)],
                                    "step string, pos int, rows_in long, rows_out long, removed long")
        return out.withColumn("removed_pct", F.round((F.col("removed") * 100.0 / F.nullif("rows_in", F.lit(0)))
                                                     .cast("decimal(20,6)"), 2).cast("decimal(6,2)"))
