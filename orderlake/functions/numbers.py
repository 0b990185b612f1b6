"""Number and boolean cleaners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions._util import col, strip
from orderlake.functions.text import strip_float_suffix

__all__ = [
    "TRUE_TOKENS", "BOOL_MAP_TRUE", "BOOL_MAP_FALSE", "to_number", "to_bigint", "money2",
    "to_int_zero", "compact_number", "bool_true_tokens", "bool_map",
    "bool_equals_label",
]

# Fixed values that must equal the reference's behaviour.
TRUE_TOKENS = ["true", "1", "yes", "y", "是"]
BOOL_MAP_TRUE = ["true", "1", "yes"]
BOOL_MAP_FALSE = ["false", "0", "no"]


# Text shapes a numeric cast can accept; checked first because a failed cast
# is far more expensive than a regex test.
NUMBER_SHAPE = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_SHAPE = "^[+-]?[0-9]+$"


def _guarded(t: Column, shape: str, to: str) -> Column:
    return F.when(t.rlike(shape), t.try_cast(to))


def to_number(c: Column | str, default: float | None = None) -> Column:
    """Numeric text -> DOUBLE; unparseable (and the text ``nan``) -> NULL
    or ``default``."""
    d = _guarded(strip(col(c).cast("string")), NUMBER_SHAPE, "double")
    return F.coalesce(d, F.lit(default).cast("double")) if default is not None else d


def to_bigint(c: Column | str) -> Column:
    """Integer text -> BIGINT, exact to the last digit; other numbers lose their
    fraction; what BIGINT can't hold, or isn't a number, is NULL."""
    t = strip(col(c).cast("string"))
    plain = F.when(t.rlike("^[+-]?[0-9]*[.]?[0-9]*$") & t.rlike("[0-9]"), F.substring_index(t, ".", 1))
    whole = F.when(plain.rlike("[0-9]"), plain.try_cast("bigint")).when(plain.isNotNull(), F.lit(0).cast("bigint"))
    return F.when(plain.isNotNull(), whole).otherwise(_guarded(t, NUMBER_SHAPE, "decimal(38,10)").try_cast("bigint"))


def money2(c: Column | str, default: float | None = None) -> Column:
    """Amount rounded half-even to 2 decimals, stored as DECIMAL(18,2).

    Rounds the exact decimal text (not a binary double), so 2.675 -> 2.68.
    An amount that the type can't hold is NULL or ``default``, like text that
    isn't a number.
    """
    d = _guarded(strip(col(c).cast("string")), NUMBER_SHAPE, "decimal(38,10)")
    out = F.bround(d, 2).try_cast("decimal(18,2)")
    return F.coalesce(out, F.lit(default).cast("decimal(18,2)")) if default is not None else out


def to_int_zero(c: Column | str) -> Column:
    """Cut decimals, coerce to BIGINT, failure -> 0."""
    s = strip_float_suffix(strip(col(c).cast("string")), mode="cut")
    return F.coalesce(_guarded(s, INTEGER_SHAPE, "bigint"), F.lit(0).cast("bigint"))


def compact_number(c: Column | str) -> Column:
    """Numeric text without a ``.0`` suffix."""
    return strip_float_suffix(strip(col(c).cast("string")), mode="zeros")


def bool_true_tokens(c: Column | str, tokens: list[str] | None = None) -> Column:
    """B1: TRUE iff the lower-cased trimmed text is a true token, else FALSE."""
    toks = TRUE_TOKENS if tokens is None else tokens
    return F.coalesce(F.lower(strip(col(c).cast("string"))).isin(*toks), F.lit(False))


def bool_map(c: Column | str) -> Column:
    """B2: true/false/1/0/yes/no (any case); unknown or NULL -> FALSE."""
    t = F.lower(strip(col(c).cast("string")))
    return (F.when(t.isin(*BOOL_MAP_TRUE), F.lit(True))
            .when(t.isin(*BOOL_MAP_FALSE), F.lit(False))
            .otherwise(F.lit(False)))


def bool_equals_label(c: Column | str, label: str) -> Column:
    """TRUE iff the trimmed text equals ``label``."""
    return F.coalesce(strip(col(c).cast("string")) == F.lit(label), F.lit(False))
