"""Table sinks (K1-K4, K7-K9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions._util import is_blank
from orderlake.functions.dates import year_month
from orderlake.operators.dedupe import key_counts

_MODES = {"truncate": "overwrite", "overwrite": "overwrite", "append": "append",
          "empty": "errorifexists", "errorifexists": "errorifexists"}


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", schema: T.StructType | None = None,
                partition_by: Sequence[str] | None = None, fmt: str = "parquet",
                sort_within: Sequence[str] | None = None, bom: bool = False, **options) -> DataFrame:
    """K1/K2/K8: enforce ``schema`` by select+cast (a cell that doesn't fit
    becomes NULL), refuse empty input, write, and return the row count read back
    from the written table.  ``bom`` marks CSV files with a header as UTF-8 for
    spreadsheets: the byte-order mark is the file's first character, before the
    first header's quote where ``quoteAll`` is set."""
    if schema is not None:
        df = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in df.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    if df.limit(1).count() == 0:
        raise ValueError("refusing to load an empty table")
    marked = bom and fmt == "csv"
    if marked and str(options.get("quoteAll")).lower() == "true":
        if partition_by:
            raise ValueError("a mark before quoted headers is not written into partition folders")
        _quoted_lines(df.sortWithinPartitions(*sort_within) if sort_within else df, options.get("sep", ",")).write.mode(
            _MODES.get(mode.lower(), mode)).text(path)
        return _loaded(df, path, fmt, {**options, "escape": '"', "header": "true"})
    if marked:
        first = next(c for c in df.columns if c not in (partition_by or ()))
        df = df.withColumnRenamed(first, "\ufeff" + first)
        sort_within = ["\ufeff" + c if c == first else c for c in sort_within or ()]
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(_MODES.get(mode.lower(), mode)).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return _loaded(df, path, fmt, options)


def _loaded(df: DataFrame, path: str, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """Rows of the written table, read back as they were written."""
    kept = {k: v for k, v in options.items() if k in ("header", "sep", "quote", "escape", "encoding", "multiLine")}
    back = df.sparkSession.read.format(fmt).options(**kept).load(path)
    return back.agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))


def _quoted_lines(df: DataFrame, sep: str) -> DataFrame:
    """Records with every cell quoted; each part starts with the mark and the header."""
    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    head = "\ufeff" + sep.join('"' + c.replace('"', '""') + '"' for c in df.columns)

    def with_head(batches):
        for k, b in enumerate(batches):
            yield pd.concat([pd.DataFrame({"value": [head]}), b]) if k == 0 else b
    return df.select(F.concat_ws(sep, *[quoted(F.col(f"`{c}`")) for c in df.columns]).alias("value")).mapInPandas(
        with_head, "value string")


def guarded_mode(df: DataFrame, key: str, mode: str, on_dup: str = "fail") -> str:
    """K3: with repeated keys an APPEND either fails (default) or becomes a
    TRUNCATE (``on_dup='overwrite'``, the reference behaviour)."""
    dup = key_counts(df, key).filter("n > 1").limit(1).count() > 0
    if dup and mode.lower() == "append":
        if on_dup == "overwrite":
            return "truncate"
        raise ValueError(f"duplicate {key} values; refusing to append")
    return mode


def load_preview(df: DataFrame, date: str, amount: str, key: str) -> DataFrame:
    """K4: dry-run summary — rows, date range, Σ amount, repeated keys."""
    d = F.to_date(F.col(date))
    base = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.min(d).alias("first_date"),
                  F.max(d).alias("last_date"),
                  F.sum(F.col(amount).try_cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_amount"))
    dups = key_counts(df, key).agg(F.count_if(F.col("n") > 1).cast("bigint").alias("repeated_keys"),
                                   F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"))
    return _side_by_side(base, dups)


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two single-row aggregates into one row (union + max, no join)."""
    cols_a, cols_b = a.columns, b.columns
    u = a.select(*cols_a, *[F.lit(None).cast(t).alias(c) for c, t in b.dtypes]) \
        .unionByName(b.select(*[F.lit(None).cast(t).alias(c) for c, t in a.dtypes], *cols_b))
    return u.agg(*[F.max(c).alias(c) for c in cols_a + cols_b])


def monthly_frame(df: DataFrame, date: str, rename: Mapping[str, str] | None = None,
                  order: Sequence[str] = ()) -> DataFrame:
    """K7 (frame): drop rows without a date, add ``year_month``, dates as
    ``yyyy-MM-dd`` text, NULL -> '', local header names."""
    d = F.to_date(F.col(date))
    out = df.filter(d.isNotNull()).withColumn("year_month", year_month(d))
    sel = []
    for c, t in out.dtypes:
        if c == "year_month":
            continue
        if t in ("date", "timestamp", "timestamp_ntz"):
            v = F.coalesce(F.date_format(F.col(c), "yyyy-MM-dd"), F.lit(""))
        else:
            v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        sel.append(v.alias((rename or {}).get(c, c)))
    return out.select(*sel, "year_month")


def monthly_export(df: DataFrame, date: str, path: str, rename: Mapping[str, str] | None = None,
                   order: Sequence[str] = (), fmt: str = "csv") -> DataFrame:
    """K7: write one folder per month with localized headers; rows inside each
    file sorted by ``order``.  Returns rows per month."""
    frame = monthly_frame(df, date, rename)
    local_order = [(rename or {}).get(c, c) for c in order]
    # range partitioning on (month, order) splits a large month over several
    # tasks (several sorted files) instead of one task per month
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = frame.repartitionByRange(n, "year_month", *local_order).sortWithinPartitions("year_month", *local_order)
    opts = {"header": "true", "quoteAll": "true"} if fmt == "csv" else {}
    w.write.mode("overwrite").format(fmt).options(**opts).partitionBy("year_month").save(path)
    return frame.groupBy("year_month").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


def date_coverage(df: DataFrame, by: str, date: str, prefix_col: str | None = None,
                  prefix: str = "orders", fallback: Sequence[Column] = ()) -> DataFrame:
    """K9: per group the first/last date and a ``<prefix>_YYYYMMDD_YYYYMMDD``
    label.  A group without dates takes the first non-blank of the ``fallback``
    texts (such as a date in its file name, then the run time)."""
    d = F.to_date(F.col(date))
    agg = df.groupBy(by).agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"),
                             F.count(F.lit(1)).cast("bigint").alias("rows"))
    p = F.col(prefix_col) if prefix_col else F.lit(prefix)
    label = F.concat_ws("_", p, F.date_format("first_date", "yyyyMMdd"), F.date_format("last_date", "yyyyMMdd"))
    other = F.coalesce(*[F.when(~is_blank(c), c) for c in fallback], F.lit("nodate"))
    return agg.withColumn("label", F.when(F.col("first_date").isNotNull(), label).otherwise(F.concat_ws("_", p, other)))
