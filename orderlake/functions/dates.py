"""Date cleaners.

Parsing uses ``try_to_timestamp`` so ANSI mode never throws on dirty cells; a
cell that fits no pattern is NULL (or '' for the text-mode helpers that mirror
text-in/text-out report steps).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions._util import col, strip

__all__ = [
    "DATE_PATTERNS", "WEEKDAY_LABELS", "pattern_shape", "parse_timestamp_multi", "parse_date_multi", "dash_date",
    "dash_datetime", "split_datetime", "parse_ampm_local", "date_from_id_yymmdd",
    "date_from_id_prefixed", "date_from_id_yyyymmdd", "weekday_sun1", "iso_week",
    "month_bounds", "year_month", "date_from_timestamp", "weekday_label",
]

# Fixed values that must equal the reference's behaviour: the order in which
# date layouts are tried (day-first before month-first decides 05/07/2025).
DATE_PATTERNS = [
    "yyyy-M-d",
    "yyyy/M/d",
    "yyyy-M-d H:m:s",
    "yyyy/M/d H:m:s",
    "yyyy-M-d H:m",
    "yyyy/M/d H:m",
    "d/M/yyyy",
    "M/d/yyyy",
    "yyyyMMdd",
]

# Weekday names used in the completeness report, Monday first.
WEEKDAY_LABELS = ["星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日"]


_REGEX_META = set(".^$*+?()[]{}|\\")


def pattern_shape(fmt: str) -> str:
    """Regex accepting exactly the text shapes a datetime pattern can parse.

    ``yyyy`` -> four digits; a doubled letter (``MM``) -> two digits; a single
    letter (``M``, ``d``, ``H``) -> one or two digits; other characters literal.
    Used as a cheap pre-check so the parser only sees candidates (a failed
    parse is far more expensive than a regex test).
    """
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        n = j - i
        if ch.isalpha():
            out.append("[0-9]{4}" if n == 4 else "[0-9]{2}" if n == 2 else "[0-9]{1,2}" if n == 1 else f"[0-9]{{{n}}}")
        else:
            out.append("".join("\\" + c if c in _REGEX_META else c for c in fmt[i:j]))
        i = j
    out.append("$")
    return "".join(out)


def _ts(c: Column, fmt: str) -> Column:
    return F.when(c.rlike(pattern_shape(fmt)), F.try_to_timestamp(c, F.lit(fmt)))


def _iso(t: Column) -> Column:
    return F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]"), t.try_cast("timestamp"))


def parse_timestamp_multi(c: Column | str, patterns: list[str] | None = None) -> Column:
    """First layout that parses wins, then ISO 8601 with a ``T``; TIMESTAMP result."""
    t = strip(c)
    pats = DATE_PATTERNS if patterns is None else patterns
    return F.coalesce(*[_ts(t, p) for p in pats], _iso(t))


def parse_date_multi(c: Column | str, patterns: list[str] | None = None) -> Column:
    """First layout that parses wins, then ISO 8601 with a ``T``; the result
    is a DATE (time dropped)."""
    return F.to_date(parse_timestamp_multi(c, patterns))


def _ymd_text(y: Column, m: Column, d: Column) -> Column:
    """Numbers of any length without leading zeros, padded to 4, 2 and 2 digits."""
    def padded(x: Column, width: int) -> Column:
        x = F.regexp_replace(x, "^0+([0-9])", "$1")
        return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)
    return F.concat_ws("-", padded(y, 4), padded(m, 2), padded(d, 2))


_SLASH3 = "^ *([0-9]+)/([0-9]+)/([0-9]+) *$"


def dash_date(c: Column | str) -> Column:
    """``Y/M/D`` -> zero-padded ``YYYY-MM-DD`` text; other text unchanged.

    Not a validating parse: ``2025/13/40`` becomes ``2025-13-40``.  Blank or
    NULL cells and slash text that is not three numbers give ''.
    """
    s = col(c)
    blank = s.isNull() | (strip(s) == "")
    has_slash = s.contains("/")
    three = F.size(F.split(s, "/")) == 3
    numeric = s.rlike(_SLASH3)
    fmt = _ymd_text(F.regexp_extract(s, _SLASH3, 1), F.regexp_extract(s, _SLASH3, 2),
                    F.regexp_extract(s, _SLASH3, 3))
    return (F.when(blank, F.lit(""))
            .when(has_slash & three & numeric, fmt)
            .when(has_slash & three, F.lit(""))
            .otherwise(s))


def dash_datetime(c: Column | str) -> Column:
    """D3: as D2 on the date part; the time part is kept verbatim."""
    s = col(c)
    blank = s.isNull() | (strip(s) == "")
    has_time = s.contains(" ")
    date_part = F.substring_index(s, " ", 1)
    time_part = F.substring(s, F.instr(s, " ") + 1, F.lit(1 << 30))
    dp_ok = date_part.rlike(_SLASH3)
    fmt = _ymd_text(F.regexp_extract(date_part, _SLASH3, 1),
                    F.regexp_extract(date_part, _SLASH3, 2),
                    F.regexp_extract(date_part, _SLASH3, 3))
    with_time = (F.when(F.size(F.split(date_part, "/")) != 3, s)
                 .when(dp_ok, F.concat(fmt, F.lit(" "), time_part))
                 .otherwise(F.lit("")))
    return (F.when(blank, F.lit(""))
            .when(~s.contains("/"), s)
            .when(has_time, with_time)
            .otherwise(dash_date(s)))


def split_datetime(c: Column | str, patterns: list[str] | None = None) -> Column:
    """One date-time cell -> struct(date DATE, time 'HH:mm:ss' text)."""
    t = strip(c)
    # the parse is one value for both fields; inlined in each it outgrows a generated method
    both = F.transform(F.array(parse_timestamp_multi(t, patterns)), lambda ts: F.struct(
        F.to_date(ts).alias("date"), F.date_format(ts, "HH:mm:ss").alias("time")))
    return F.get(both, F.lit(0))


def parse_ampm_local(c: Column | str) -> Column:
    """``2025/7/6 上午 12:00:00`` -> date of the part before the marker;
    anything else through the generic multi-layout parse."""
    s = strip(c)
    marked = s.contains("上午") | s.contains("下午")
    before = F.trim(F.regexp_extract(s, "^(.*?)(上午|下午)", 1))
    return F.when(marked, F.coalesce(F.to_date(_ts(before, "yyyy/M/d")), parse_date_multi(s))) \
        .otherwise(parse_date_multi(s))


def date_from_id_yymmdd(c: Column | str, strict: bool = False) -> Column:
    """First six digits of an order id as ``20YY-MM-DD`` text.

    Month/day are not validated (text mode, '' when not six digits); with
    ``strict=True`` the result is a DATE and impossible dates are NULL.
    """
    s = col(c)
    head = F.substring(s, 1, 6)
    ok = head.rlike("^[0-9]{6}$")
    txt = F.concat(F.lit("20"), F.substring(head, 1, 2), F.lit("-"),
                   F.substring(head, 3, 2), F.lit("-"), F.substring(head, 5, 2))
    if strict:
        return F.when(ok, F.to_date(_ts(txt, "yyyy-MM-dd")))
    return F.when(ok, txt).otherwise(F.lit(""))


def date_from_id_prefixed(c: Column | str) -> Column:
    """D6 (prefixed ids such as ``RM250621…``): characters 3-8 -> ``YYYY/MM/DD``."""
    s = col(c)
    part = F.substring(s, 3, 6)
    ok = (F.length(s) >= 6) & part.rlike("^[0-9]{6}$")
    txt = F.concat(F.lit("20"), F.substring(part, 1, 2), F.lit("/"),
                   F.substring(part, 3, 2), F.lit("/"), F.substring(part, 5, 2))
    return F.when(ok, txt).otherwise(F.lit(""))


def date_from_id_yyyymmdd(c: Column | str) -> Column:
    """First eight characters parsed strictly as ``yyyyMMdd``."""
    return F.to_date(_ts(F.substring(col(c), 1, 8), "yyyyMMdd"))


def weekday_sun1(c: Column | str) -> Column:
    """Sunday=1 … Saturday=7."""
    return F.dayofweek(col(c))


def iso_week(c: Column | str) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(col(c))


def month_bounds(yyyymm: Column | str) -> Column:
    """``YYYYMM`` text -> struct(first_day, last_day)."""
    first = F.to_date(_ts(F.concat(col(yyyymm), F.lit("01")), "yyyyMMdd"))
    return F.struct(first.alias("first_day"), F.last_day(first).alias("last_day"))


def year_month(c: Column | str) -> Column:
    """``yyyy-MM`` month label of a date."""
    return F.date_format(col(c), "yyyy-MM")


def date_from_timestamp(c: Column | str) -> Column:
    """Timestamp text -> ``yyyy-MM-dd`` text, '' when unparseable."""
    s = strip(c)
    ts = F.coalesce(_ts(s, "yyyy-M-d H:m:s"), _ts(s, "yyyy-M-d H:m"), _ts(s, "yyyy-M-d"),
                    _ts(s, "yyyy/M/d H:m:s"), _ts(s, "yyyy/M/d H:m"), _ts(s, "yyyy/M/d"), _iso(s))
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(""))


def weekday_label(c: Column | str, labels: list[str] | None = None) -> Column:
    """Localized weekday name (labels listed Monday first)."""
    labs = WEEKDAY_LABELS if labels is None else labels
    # dayofweek: Sunday=1 … Saturday=7 -> Monday-first index 1..7
    idx = ((F.dayofweek(col(c)) + 5) % 7) + 1
    return F.element_at(F.array(*[F.lit(x) for x in labs]), idx)
