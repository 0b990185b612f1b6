from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def orderable(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns usable as tie-breakers (everything except maps)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, T.MapType)]


def null_safe_eq(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


#: Broadcast at most this many bytes of column values.
BROADCAST_BYTES = 64 << 20


def _width(df: DataFrame) -> Column:
    """Bytes of a row's values: text, binary and nested values by their length."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        fixed = isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
        value = F.col(f"`{f.name}`")
        text = value if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.to_json(F.struct(value))
        total = total + (F.lit(16) if fixed else F.coalesce(F.octet_length(text), F.lit(0)) + 16)
    return total


def proven_small(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def sized_broadcast(dim: DataFrame, max_rows: int = 2_000_000, bound_by: DataFrame | None = None,
                    max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` only when it is proven to hold at most ``max_rows`` rows
    and ``max_bytes`` bytes of values.

    The check is one aggregate with partial sums.  ``bound_by`` may name a
    cheaper frame with at least the rows and the columns of ``dim`` (e.g. the
    raw master before de-duplication), so the check is a plain scan instead of
    running ``dim``'s own shuffle.  Larger dimensions stay un-hinted: the planner
    and AQE decide by their own sizes, and the result is the same.
    """
    probe = bound_by if bound_by is not None else dim
    return F.broadcast(dim) if proven_small(probe, max_rows, max_bytes) else dim
