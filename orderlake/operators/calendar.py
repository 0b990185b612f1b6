"""Completeness audits: missing days (W8), missing ranges (W9), completeness
percentage (A13), date validity (A12) and missing-counterpart counts (A10, F3).

Calendars are generated with ``sequence``/``explode`` per group; their size is
bounded by the covered date span (days), not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions._util import is_blank
from orderlake.operators._common import as_list


def _days(df: DataFrame, date: Column | str, by) -> DataFrame:
    d = F.col(date) if isinstance(date, str) else date
    return df.select(*by, F.to_date(d).alias("day")).filter(F.col("day").isNotNull()).distinct()


def calendar(df: DataFrame, date, by=None) -> DataFrame:
    """Every day between the first and last date (per group)."""
    by = as_list(by)
    days = _days(df, date, by)
    span = days.groupBy(*by).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    return span.select(*by, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))


def missing_days(df: DataFrame, date, by=None) -> DataFrame:
    """Calendar days (between min and max) with no row."""
    by = as_list(by)
    return calendar(df, date, by).join(_days(df, date, by), by + ["day"], "left_anti")


def missing_ranges(days: DataFrame, by=None, day: str = "day") -> DataFrame:
    """Collapse missing days into runs (gaps and islands).

    ``date_sub(day, row_number)`` is constant along consecutive days.  The
    window is partitioned by group only and holds at most one row per
    calendar day, so it is bounded by the date span.
    """
    by = as_list(by)
    w = Window.partitionBy(*by).orderBy(day)
    isl = days.withColumn("__grp", F.date_sub(F.col(day), F.row_number().over(w).cast("int")))
    rng = isl.groupBy(*by, "__grp").agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"),
                                         F.count(F.lit(1)).cast("bigint").alias("n_days"))
    label = F.when(F.col("start_day") == F.col("end_day"), F.col("start_day").cast("string")) \
        .otherwise(F.concat(F.col("start_day").cast("string"), F.lit("~"), F.col("end_day").cast("string")))
    return rng.select(*by, "start_day", "end_day", "n_days", label.alias("label"))


def completeness(df: DataFrame, date, by=None) -> DataFrame:
    """Days covered, days missing and (days − missing)/days × 100 to 1 dp."""
    by = as_list(by)
    cal = calendar(df, date, by)
    have = _days(df, date, by).withColumn("__have", F.lit(1))
    j = cal.join(have, by + ["day"], "left")
    agg = j.groupBy(*by).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count(F.lit(1)).cast("bigint").alias("total_days"),
        F.count_if(F.col("__have").isNull()).cast("bigint").alias("missing_days"))
    pct = F.round(((F.col("total_days") - F.col("missing_days")) * 100.0 / F.col("total_days"))
                  .cast("decimal(20,6)"), 1).cast("decimal(5,1)")
    return agg.withColumn("completeness_pct", pct)


def date_validity(df: DataFrame, parsed: Column | str, by: str) -> DataFrame:
    """Rows, valid, invalid and valid % per ``by`` value ("file") plus an
    overall row with ``by`` = NULL."""
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    base = df.select(F.col(by).alias("file"), p.isNotNull().alias("__ok"))
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows"),
            F.count_if("__ok").cast("bigint").alias("valid"),
            F.count_if(~F.col("__ok")).cast("bigint").alias("invalid")]
    per = base.groupBy("file").agg(*aggs)
    tot = base.agg(*aggs).select(F.lit(None).cast("string").alias("file"), "rows", "valid", "invalid")
    out = per.unionByName(tot)
    pct = F.round((F.col("valid") * 100.0 / F.col("rows")).cast("decimal(20,6)"), 2).cast("decimal(6,2)")
    return out.withColumn("valid_pct", pct)


#: Days of one bitmap, and what makes the number of every DATE since 1970 positive.
MAP_DAYS = 32_768
_FIRST_DAY = 3_000_000


def _number(day: Column) -> Column:
    return F.unix_date(day).cast("long") + _FIRST_DAY


def day_maps(df: DataFrame, date: Column | str, by=None) -> DataFrame:
    """One bitmap of the days that occur per ``by`` values and stretch of
    MAP_DAYS days: by..., bucket, bits, first, last (day numbers).  A task builds
    its bitmaps while it scans, so only 4 kB per file and stretch are shuffled,
    whatever the rows; ``merge_day_maps`` adds such bitmaps up."""
    by = as_list(by)
    d = F.col(date) if isinstance(date, str) else date
    days = df.select(*by, _number(F.to_date(d)).alias("n")).filter(F.col("n").isNotNull())
    return days.groupBy(*by, F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"), F.min("n").alias("first"), F.max("n").alias("last"))


def merge_day_maps(maps: DataFrame, by=None) -> DataFrame:
    """The bitmaps of ``by`` values (default: of all), each day set that any has."""
    return maps.groupBy(*as_list(by), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"))


def map_days(maps: DataFrame, by=None, present: bool = True) -> DataFrame:
    """(by..., day) of the days between the first and the last one that the
    bitmaps have (or, not ``present``, don't have).  Work follows the days, not rows."""
    by = as_list(by)
    spans = maps.groupBy(*by).agg(F.min("first").alias("lo"), F.max("last").alias("hi"))
    bucket = lambda n: F.bitmap_bucket_number(n)                                                  # noqa: E731
    stretches = spans.select(*by, "lo", "hi", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))).alias("bucket"))
    own = maps.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("bucket").alias("_bucket"), "bits")
    on = F.col("bucket") == F.col("_bucket")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    begin = (F.col("bucket") - 1) * MAP_DAYS + 1
    days = stretches.join(own, on, "left").select(*by, "bits", begin.alias("_b"), F.explode(F.sequence(
        F.greatest("lo", begin), F.least("hi", begin + MAP_DAYS - 1))).alias("n"))
    at = F.col("n") - F.col("_b")
    byte = F.conv(F.hex(F.substr("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1))
    return days.filter(F.coalesce(bit, F.lit(0)) == int(present)).select(
        *by, F.date_from_unix_date((F.col("n") - _FIRST_DAY).cast("int")).alias("day"))


def missing_dates(df: DataFrame, date: Column | str, by: str = "file") -> DataFrame:
    """(scope, ``by``, day) of missing days, from one pass over the rows.

    scope ``file``: days without a row between the file's first and last one;
    ``any``: the days that are missing in some file, each once; ``all``: those
    between the first and the last day of all files that no file has.  The
    file's name is NULL in the last two.  Files without a date have no rows."""
    maps = day_maps(df, date, by).checkpoint(eager=True)          # one row per file and 90 years
    per_file = map_days(maps, by, present=False)
    kind = maps.schema[by].dataType
    union = map_days(day_maps(per_file, "day"))
    none = map_days(merge_day_maps(maps), present=False)
    out = per_file.select(F.lit("file").alias("scope"), by, "day")
    for scope, days in (("any", union), ("all", none)):
        out = out.unionByName(days.select(F.lit(scope).alias("scope"), F.lit(None).cast(kind).alias(by), "day"))
    return out


def missing_counterpart(df: DataFrame, counterpart: DataFrame, keys, exclude_status: str | None = None,
                        status: str | None = None, date: str | None = None) -> DataFrame:
    """rows with a date and key but no counterpart row, excluding statuses
    matching ``exclude_status`` (a NULL status never matches)."""
    keys = as_list(keys)
    out = df
    for k in keys + ([date] if date else []):
        out = out.filter(~is_blank(k))
    if exclude_status and status:
        out = out.filter(~F.coalesce(F.col(status).rlike(exclude_status), F.lit(False)))
    ck = counterpart.select(*keys).distinct()
    return out.join(ck, keys, "left_anti")


def missing_by_day(rows: DataFrame, date: str, key: str) -> DataFrame:
    """A10: per day, number of distinct keys."""
    return (rows.groupBy(F.to_date(F.col(date)).alias("day"))
            .agg(F.countDistinct(key).cast("bigint").alias("n_orders")))
