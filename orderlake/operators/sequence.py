"""Sequence numbering within groups (W5, W6) and consecutive-run numbering.

A plain ``row_number() over (partition by g order by …)`` sends a whole group
to one task; with one group holding a third of the table that task never
finishes.  These operators run a *segmented scan* instead, on built-in
functions only:

1. range-partition on (group, order, every other column) — a total order, so a
   hot group is spread over many partitions and numbering is deterministic —
   and tag each row with its partition and its place there; the tagged table is
   written to the shared checkpoint folder (lineage cut, survives executor loss);
2. ``lag`` inside each range partition gives the row before; the first row of a
   partition gets the last row of the partition before it from a table of one
   row per partition;
3. a running maximum of the break positions numbers the rows inside a partition;
4. windows over one row per partition carry the open segment's length across
   partitions, and a broadcast join on the partition number adds it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators._common import as_list, orderable
from orderlake.session import scratch_path

#: (row before, row) as struct columns -> whether a new segment starts.
BreakRule = Callable[[Column, Column], Column]

_IN_PARTITION = (1 << 33) - 1        # monotonically_increasing_id: partition above, place below


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def group_change(cols: Sequence[str]) -> BreakRule:
    """Break whenever any of ``cols`` differs from the row before (NULL = NULL)."""
    def rule(prev: Column, cur: Column) -> Column:
        out = F.lit(False)
        for c in cols:
            out = out | ~prev.getField(c).eqNullSafe(cur.getField(c))
        return out
    return rule


def segmented_number(df: DataFrame, sort: Sequence[tuple[str, bool]], watch: Sequence[str],
                     breaks: BreakRule, out: str = "seq", partitions: int | None = None) -> DataFrame:
    """Number rows 1, 2, … inside segments of the total order ``sort``.

    ``breaks(prev, cur)`` sees the ``watch`` columns of each row and of the row
    before it.  Returns ``df`` plus a BIGINT column ``out``.  Rows equal in all
    columns are interchangeable.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _total_order(df, list(sort))
    at = F.monotonically_increasing_id()
    tagged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        *[_c(c) for c in df.columns], F.shiftright(at, 33).cast("int").alias("__pid"),
        at.bitwiseAND(F.lit(_IN_PARTITION)).alias("__row"))
    path = scratch_path(spark, f"segscan-{uuid.uuid4().hex}")
    tagged.write.parquet(path)
    rows = spark.read.schema(tagged.schema).parquet(path).withColumn("__cur", F.struct(*[_c(c) for c in watch]))

    by_pid = Window.orderBy("__pid")                      # one row per partition
    ends = rows.groupBy("__pid").agg(F.max_by("__cur", "__row").alias("__last"))
    ends = ends.select("__pid", F.lag("__last").over(by_pid).alias("__before"))
    inside = Window.partitionBy("__pid").orderBy("__row")
    prev = F.when(F.col("__row") == 0, F.col("__before")).otherwise(F.lag("__cur").over(inside))
    seen = rows.join(F.broadcast(ends), "__pid").withColumn("__prev", prev)
    broken = F.col("__prev").isNull() | breaks(F.col("__prev"), F.col("__cur"))
    seen = seen.withColumn("__from", F.max(F.when(broken, F.col("__row"))).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    tails = seen.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.max("__from").alias("__open"))
    tails = tails.withColumn("__part", F.sum(F.col("__open").isNotNull().cast("int")).over(by_pid))
    length = F.sum(F.col("__n") - F.coalesce("__open", F.lit(0))).over(
        Window.partitionBy("__part").orderBy("__pid"))      # rows of the segment that is open at the end
    carry = tails.withColumn("__length", length).select(
        "__pid", F.coalesce(F.lag("__length").over(by_pid), F.lit(0)).alias("__carry"))
    number = F.when(F.col("__from").isNotNull(), F.col("__row") - F.col("__from") + 1).otherwise(
        F.col("__carry") + F.col("__row") + 1)
    return seen.join(F.broadcast(carry), "__pid").withColumn("__out", number.cast("bigint")).select(
        *[_c(c) for c in df.columns if c != out], F.col("__out").alias(out))


def _total_order(df: DataFrame, spec: list[tuple[str, bool]], skip: Sequence[str] = ()) -> list:
    named = [c for c, _ in spec]
    order = [_c(c).asc_nulls_first() if asc else _c(c).desc_nulls_last() for c, asc in spec if c not in skip]
    return order + [_c(c).asc_nulls_first() for c in orderable(df, exclude=[*named, *skip])]


def number_within(df: DataFrame, group, order, out: str = "seq", pad: int | None = None,
                  partitions: int | None = None, method: str = "scan",
                  max_group_rows: int = 1_000_000) -> DataFrame:
    """1-based position of each row inside its group under ``order``.

    ``order`` is a list of column names (ascending) or ``(name, ascending)``
    pairs; remaining columns break ties.  With ``pad`` a zero-padded text copy
    ``{out}_text`` is added (no truncation of wider numbers).

    ``method`` picks a plan, never a result.  ``'scan'`` (default) is the
    skew-safe segmented scan.  ``'window'`` is one ``row_number`` window — one
    shuffle and no written intermediate, but each group is processed by one
    task: use it only where group sizes are known to be bounded (e.g. lines per
    order).  ``'auto'`` measures the largest group (a map-side-combined count)
    and takes the window plan only when it holds at most ``max_group_rows``.
    """
    group = as_list(group)
    spec = [(g, True) for g in group] + [o if isinstance(o, tuple) else (o, True) for o in as_list(order)]
    if method == "auto":
        biggest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0
        method = "window" if biggest <= max_group_rows else "scan"
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*_total_order(df, spec, group))
        res = df.withColumn(out, F.row_number().over(w).cast("bigint"))
    else:
        res = segmented_number(df, spec, group, group_change(group), out=out, partitions=partitions)
    if pad:
        txt = F.col(out).cast("string")
        res = res.withColumn(f"{out}_text", F.when(F.length(txt) < pad, F.lpad(txt, pad, "0")).otherwise(txt))
    return res


def global_sequence(df: DataFrame, order, out: str = "seq", partitions: int | None = None) -> DataFrame:
    """1-based position of every row in the total order ``order`` (no group)."""
    spec = [o if isinstance(o, tuple) else (o, True) for o in as_list(order)]
    return segmented_number(df, spec, [spec[0][0]], lambda prev, cur: F.lit(False), out=out, partitions=partitions)


def _digits(c: Column, prefix: str) -> tuple[Column, Column]:
    """(negative, digits without leading zeros) of an id after removing the text
    ``prefix``; digits are NULL where the rest isn't an integer.  Text, so ids of
    any length compare exactly."""
    t = F.trim(F.replace(c, F.lit(prefix), F.lit("")) if prefix else c)
    digits = F.when(t.rlike("^[+-]?[0-9]+$"), F.regexp_replace(t, "^[+-]?0*([0-9])", "$1"))
    return t.startswith("-") & (digits != "0"), digits


def _successor(digits: Column) -> Column:
    """Digits of the next natural number: the nines at the end become zeros and
    the digit before them grows by one."""
    head = F.regexp_replace(digits, "9+$", "")
    zeros = F.repeat(F.lit("0"), F.length(digits) - F.length(head))
    grown = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), (F.right(head, F.lit(1)).try_cast("int") + 1).cast("string"))
    return F.concat(F.when(head == "", F.lit("1")).otherwise(grown), zeros)


def run_breaks(date: str, recipient: str, order_id: str, prefix: str = "RM",
               scope: Sequence[str] = ()) -> BreakRule:
    """W7 rule: a new run starts when scope/date/recipient change, or when both
    ids are non-blank and the id is not the previous id + 1 (or does not
    parse).  A blank id on either side continues the run."""
    change = group_change([*scope, date, recipient])

    def rule(prev: Column, cur: Column) -> Column:
        p, q = prev.getField(order_id).cast("string"), cur.getField(order_id).cast("string")
        filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))          # noqa: E731
        (pn, pd), (qn, qd) = _digits(p, prefix), _digits(q, prefix)
        up = ~pn & ~qn & (qd == _successor(pd))
        down = pn & (qn | (qd == "0")) & (pd == _successor(qd))               # below zero
        return change(prev, cur) | (filled(p) & filled(q) & ~F.coalesce(up | down, F.lit(False)))
    return rule


def consecutive_runs(df: DataFrame, date: str, recipient: str, order_id: str,
                     prefix: str = "RM", scope: Sequence[str] = (), out: str = "line_no",
                     partitions: int | None = None, method: str = "scan") -> DataFrame:
    """Number rows inside runs of consecutive order ids.

    Rows are ordered by (scope, date, recipient, order_id as text); see
    ``run_breaks`` for the run rule.  ``out`` is the 1-based number as text.
    ``method='window'`` gives the same result by lag / running sum / row_number
    per (scope, date, recipient) — one task per such group, so only for bounded
    groups; the default segmented scan is skew-safe.
    """
    groups = [*scope, date, recipient]
    rule = run_breaks(date, recipient, order_id, prefix, scope)
    spec = [(c, True) for c in [*groups, order_id]]
    if method == "window":
        order = _total_order(df, spec, groups)
        w = Window.partitionBy(*groups).orderBy(*order)
        t = df.withColumn("__cur", F.struct(*[_c(c) for c in [*groups, order_id]])).withColumn(
            "__prev", F.lag("__cur").over(w))
        broken = F.col("__prev").isNull() | rule(F.col("__prev"), F.col("__cur"))
        t = t.withColumn("__run", F.sum(broken.cast("long")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__cur", "__prev")
        w2 = Window.partitionBy(*groups, "__run").orderBy(*order)
        return t.withColumn(out, F.row_number().over(w2).cast("string")).drop("__run")
    res = segmented_number(df, spec, [*groups, order_id], rule, out=out, partitions=partitions)
    return res.withColumn(out, F.col(out).cast("string"))
