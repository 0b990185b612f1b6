"""Ordering of report rows.

A global ``orderBy`` is one range-partitioned shuffle (sampled bounds), so it
scales; sorts that only matter inside output files use
``sortWithinPartitions`` at write time instead (see ``sinks.write_table``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions._util import strip
from orderlake.functions.numbers import NUMBER_SHAPE, to_number


def numeric_key(c: Column | str) -> Column:
    """O1: numeric value of id text (unparseable -> NULL)."""
    return to_number(c)


def prefixed_id_key(c: Column | str, prefix: str = "RM") -> Column:
    """O2: digits (without leading zeros) of an id that is ``prefix`` and digits;
    any other id -> '0'.  Text of any length: order it by ``prefixed_id_order``."""
    x = F.col(c) if isinstance(c, str) else c
    rest = F.substr(x, F.lit(len(prefix) + 1))
    conforming = x.startswith(prefix) & rest.rlike("^[0-9]+$")
    return F.coalesce(F.when(conforming, F.regexp_replace(rest, "^0+([0-9])", "$1")), F.lit("0"))


def prefixed_id_order(c: Column | str, prefix: str = "RM") -> list[Column]:
    """O2: sort keys that order ids by their number (fewer digits first)."""
    key = prefixed_id_key(c, prefix)
    return [F.length(key), key]


def sort_numeric(df: DataFrame, c: str, *then: str) -> DataFrame:
    """O1: ascending by the numeric value of text ids, NULL (unparseable) last."""
    text = strip(F.col(c).cast("string"))
    exact = F.when(text.rlike(NUMBER_SHAPE), text.try_cast("decimal(38,10)"))       # where doubles are equal
    return df.orderBy(numeric_key(c).asc_nulls_last(), exact.asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in then])


def sort_prefixed_id(df: DataFrame, c: str, prefix: str = "RM", invalid: Column | None = None,
                     *then: str) -> DataFrame:
    """O2 + F4: by the prefixed id's number; the invalid rows (``invalid``, else
    those whose id is NULL or empty) come after all valid ones."""
    invalid = ~filled(c) if invalid is None else F.coalesce(invalid, F.lit(False))
    order = [invalid.asc(), *prefixed_id_order(c, prefix), F.col(c).asc_nulls_last()]
    return df.orderBy(*order, *[F.col(t).asc_nulls_last() for t in then])


def filled(c: str) -> Column:
    """an id counts as valid when it is neither NULL nor empty."""
    return F.coalesce(F.col(c) != "", F.lit(False))


def sort_by(df: DataFrame, *cols: str) -> DataFrame:
    """O3: multi-key ascending sort, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows after a total order (top-k; Spark keeps only n per task)."""
    cols = list(order) or df.columns
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(n)


def valid_invalid_split(df: DataFrame, valid: Column, *order: str) -> DataFrame:
    """valid rows sorted by ``order``, invalid rows appended after them."""
    return df.orderBy((~F.coalesce(valid, F.lit(False))).asc(), *[F.col(c).asc_nulls_last() for c in order])
