"""String cleaners.

Every function maps a Column (or column name) to a Column built only from
Spark built-ins, so it stays inside whole-stage codegen.  Regular expressions
keep to the subset that Java regex and RE2 read alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions._util import SPACES, blank_to_null, col, strip

__all__ = [
    "NULL_TOKENS", "WS", "normalize_ws", "strip_newlines", "null_tokens",
    "strip_float_suffix", "zero_pad", "pad_right", "unquote_formula",
    "text_guard_prefix", "format_phone", "truncate_at_word", "zip_prefix",
    "strip_control_chars", "line_uid", "split_composite_id", "is_abnormal_long",
    "is_abnormal_subseq", "product_ref_from_name", "strip_leading_zeros",
    "integral_text", "clean_code",
]

# Fixed values that must equal the reference's behaviour:
# text spellings that mean "missing" in exported reports.
NULL_TOKENS = ["nan", "None", "NULL", "null", "NaN", "NAN", "NaT", "Null"]

# white space class
WS = f"[{SPACES}]"


def normalize_ws(c: Column | str, blank_as_null: bool = False) -> Column:
    """CR/LF become spaces, whitespace runs (Unicode spaces too) collapse to
    one space, trim."""
    out = F.trim(F.regexp_replace(col(c), WS + "+", " "))
    return blank_to_null(out) if blank_as_null else out


def strip_newlines(c: Column | str) -> Column:
    """CR/LF removed, whitespace runs (Unicode spaces too) collapse to one
    space, trim."""
    out = F.regexp_replace(col(c), "[\\r\\n]", "")
    return F.trim(F.regexp_replace(out, WS + "+", " "))


def null_tokens(c: Column | str, tokens: list[str] | None = None) -> Column:
    """A cell equal to a null token (after trim) becomes NULL."""
    c = col(c)
    toks = NULL_TOKENS if tokens is None else tokens
    return F.when(strip(c).isin(*toks), F.lit(None).cast("string")).otherwise(c)


def strip_float_suffix(c: Column | str, mode: str = "zeros") -> Column:
    """T4: drop a float suffix from integral text.

    ``zeros``: remove a trailing ``.0``/``.00…``; ``cut``: keep text before the
    first ``.``.
    """
    c = col(c)
    if mode == "cut":
        return F.substring_index(c, ".", 1)
    return F.regexp_replace(c, "\\.0+$", "")


def zero_pad(c: Column | str, width: int) -> Column:
    """T5: left pad with zeros to ``width`` without truncating longer text."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def pad_right(c: Column | str, width: int) -> Column:
    """Right pad with zeros to ``width`` without truncating."""
    c = col(c)
    return F.when(F.length(c) < width, F.rpad(c, width, "0")).otherwise(c)


def unquote_formula(c: Column | str) -> Column:
    """``="x"`` -> x, ``"x"`` -> x, otherwise trimmed text."""
    t = strip(c)
    return (F.when(t.rlike('^=".*"$'), F.regexp_extract(t, '^="(.*)"$', 1))
            .when(t.rlike('^".*"$'), F.regexp_extract(t, '^"(.*)"$', 1))
            .otherwise(t))


def text_guard_prefix(c: Column | str) -> Column:
    """Prefix ``'`` so spreadsheets keep ids as text (export only)."""
    c = col(c)
    return F.when(c.isNull() | (c == ""), c).otherwise(F.concat(F.lit("'"), c))


def format_phone(c: Column | str, variant: str = "prefix") -> Column:
    """Phone text.

    ``prefix``: drop ``.0``, non-blank -> ``'0`` + digits (text-guarded).
    ``nine``: drop ``.0``; 9 digits starting with 9 -> ``0`` + x.
    """
    x = F.regexp_replace(strip(c), "\\.0$", "")
    if variant == "nine":
        return F.when(x.rlike("^9[0-9]{8}$"), F.concat(F.lit("0"), x)).otherwise(x)
    return F.when(x.isNull() | (x == ""), x).otherwise(F.concat(F.lit("'0"), x))


def truncate_at_word(c: Column | str, word: str = "無", anchored: bool = False) -> Column:
    """Drop text from ``word`` to the end (whole cell if anchored)."""
    c = col(c)
    if anchored:
        return F.when(strip(c) == word, F.lit("")).otherwise(c)
    return strip(F.regexp_replace(c, word + ".*$", ""))


def zip_prefix(c: Column | str, n: int = 3) -> Column:
    """First ``n`` characters of the trimmed zip code."""
    return F.substring(strip(c), 1, n)


def strip_control_chars(c: Column | str) -> Column:
    """Remove C0/C1 control characters except TAB, LF and CR."""
    return F.regexp_replace(col(c), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]", "")


def line_uid(*parts: Column | str, sep: str = "_", prefix: str = "") -> Column:
    """Join key parts with ``sep``; NULL parts count as ''."""
    cols = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    out = F.concat_ws(sep, *cols)
    return F.concat(F.lit(prefix), out) if prefix else out


def split_composite_id(c: Column | str, strict: bool = True) -> Column:
    """``a-b-c-d`` -> struct(line, sub, detail, extra).

    strict: anything other than exactly four parts gives (first, 001, 001, 001);
    text without a dash is the main part.  lenient: missing parts become 001.
    """
    s = col(c)
    parts = F.split(s, "-")
    n = F.size(parts)
    one = F.lit("001")
    first = F.get(parts, 0)

    def part(i):
        return F.coalesce(F.get(parts, i), one)

    if strict:
        four = n == 4
        return F.struct(
            first.alias("order_main"),
            F.when(four, F.get(parts, 1)).otherwise(one).alias("order_line"),
            F.when(four, F.get(parts, 2)).otherwise(one).alias("order_sub"),
            F.when(four, F.get(parts, 3)).otherwise(one).alias("order_detail"),
        )
    return F.struct(first.alias("order_main"), part(1).alias("order_line"),
                    part(2).alias("order_sub"), part(3).alias("order_detail"))


def is_abnormal_long(c: Column | str) -> Column:
    """T15-A: id longer than 17 characters and not ending ``001-001``."""
    s = F.coalesce(col(c), F.lit(""))
    return (F.length(s) > 17) & ~s.endswith("001-001")


def is_abnormal_subseq(sub: Column | str, detail: Column | str) -> Column:
    """T15-B: abnormal unless both sub and detail sequences are ``001``."""
    s, d = col(sub), col(detail)
    return ~(F.coalesce(s == "001", F.lit(False)) & F.coalesce(d == "001", F.lit(False)))


def product_ref_from_name(c: Column | str, option_width: int = 3) -> Column:
    """Trailing ``(ID-nn)`` of a product name -> struct(ref_id, option).

    The id is letters and digits of any script, ``_`` and ``-``.  The option
    part is zero-padded to ``option_width``; no match gives NULLs.
    """
    s = col(c)
    pat = "\\(([\\p{L}\\p{N}_-]+)-([0-9]{1,3})\\)$"
    hit = s.rlike(pat)
    ref = F.regexp_extract(s, pat, 1)
    opt = F.regexp_extract(s, pat, 2)
    return F.struct(
        F.when(hit, ref).alias("ref_id"),
        F.when(hit, zero_pad(opt, option_width)).alias("ref_option"),
    )


def strip_leading_zeros(c: Column | str) -> Column:
    """``lstrip('0')``."""
    return F.regexp_replace(col(c), "^0+", "")


def integral_text(c: Column | str) -> Column:
    """Integral numbers written as floats lose their ``.0`` suffix."""
    c = col(c)
    return F.when(c.rlike("^-?[0-9]+\\.0+$"), F.regexp_replace(c, "\\.0+$", "")).otherwise(c)


def clean_code(c: Column | str) -> Column:
    """Lookup code cleanup — trim, drop ``.0``, blank / ``nan`` -> NULL."""
    t = F.regexp_replace(strip(col(c).cast("string")), "\\.0$", "")
    return F.when((t == "") | F.lower(t).isin("nan", "none", "null"), F.lit(None).cast("string")).otherwise(t)
