from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters that count as white space in report cells: the Unicode ones (such as
# the no-break and the ideographic space) and the ASCII separators.
SPACES = "\\t-\\r\\x1c- \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


# the same characters one by one
SPACE_CHARS = "".join(chr(k) for a, b in [(0x09, 0x0d), (0x1c, 0x20), (0x85, 0x85), (0xa0, 0xa0), (0x1680, 0x1680),
                                          (0x2000, 0x200a), (0x2028, 0x2029), (0x202f, 0x202f), (0x205f, 0x205f),
                                          (0x3000, 0x3000)] for k in range(a, b + 1))


def strip(c: Column | str) -> Column:
    """Text without white space at either end."""
    return F.btrim(col(c), F.lit(SPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    """NULL, empty or white space only."""
    return ~F.coalesce(col(c).cast("string").rlike(f"[^{SPACES}]"), F.lit(False))


def blank_to_null(c: Column | str) -> Column:
    """'' and whitespace-only text become NULL."""
    c = col(c)
    return F.when(~is_blank(c), c)
