import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake import functions as fn


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_normalize_and_strip_newlines(spark):
    vals = ["  a b\r\nc\t d ", "x\n\ny", "   ", None]
    assert one_col(spark, vals, fn.normalize_ws) == ["a b c d", "x y", "", None]
    assert one_col(spark, vals, lambda c: fn.normalize_ws(c, blank_as_null=True)) == ["a b c d", "x y", None, None]
    assert one_col(spark, vals, fn.strip_newlines) == ["a bc d", "xy", "", None]


def test_null_tokens_and_control_chars(spark):
    assert one_col(spark, ["nan", "None", " NaT ", "ok", None], fn.null_tokens) == [None, None, None, "ok", None]
    assert one_col(spark, ["a\x00b\x1fc\x7fd\x9fe\tf"], fn.strip_control_chars) == ["abcde\tf"]


def test_padding_never_truncates(spark):
    assert one_col(spark, ["123", "1", "12345"], lambda c: fn.zero_pad(c, 3)) == ["123", "001", "12345"]
    assert one_col(spark, ["9376621712", "123456789012345678"], lambda c: fn.pad_right(c, 11)) == \
        ["93766217120", "123456789012345678"]


def test_float_suffix_and_integral(spark):
    assert one_col(spark, ["12.0", "12.00", "12.5", "7"], fn.strip_float_suffix) == ["12", "12", "12.5", "7"]
    assert one_col(spark, ["12.7", "3"], lambda c: fn.strip_float_suffix(c, "cut")) == ["12", "3"]
    assert one_col(spark, ["5.0", "5.5", "-3.00", "abc"], fn.integral_text) == ["5", "5.5", "-3", "abc"]


def test_unquote_phone_note_zip(spark):
    assert one_col(spark, ['="0912345678"', '"abc"', " x "], fn.unquote_formula) == ["0912345678", "abc", "x"]
    assert one_col(spark, ["912345678.0", "", None], fn.format_phone) == ["'0912345678", "", None]
    assert one_col(spark, ["912345678.0", "0223456789"], lambda c: fn.format_phone(c, "nine")) == \
        ["0912345678", "0223456789"]
    assert one_col(spark, ["無", "請勿按鈴，無電梯", "ok"], fn.truncate_at_word) == ["", "請勿按鈴，", "ok"]
    assert one_col(spark, ["無", "請勿按鈴，無電梯"], lambda c: fn.truncate_at_word(c, anchored=True)) == \
        ["", "請勿按鈴，無電梯"]
    assert one_col(spark, [" 10048 "], fn.zip_prefix) == ["100"]
    assert one_col(spark, ["000120", "0"], fn.strip_leading_zeros) == ["120", ""]


def test_line_uid(spark):
    df = spark.createDataFrame([("123", "01"), ("9", None)], "a string, b string")
    assert [r[0] for r in df.select(fn.line_uid("a", "b")).collect()] == ["123_01", "9_"]
    assert [r[0] for r in df.select(fn.line_uid("a", prefix="mk_")).collect()] == ["mk_123", "mk_9"]


def test_split_composite_id(spark):
    ids = ["25072112345678-001-001-001", "25072112345678-001-002-001", "25072112345678-001", "2507211234"]
    df = spark.createDataFrame([(i,) for i in ids], "x string")
    strict = [tuple(r[0]) for r in df.select(fn.split_composite_id("x")).collect()]
    assert strict == [("25072112345678", "001", "001", "001"), ("25072112345678", "001", "002", "001"),
                      ("25072112345678", "001", "001", "001"), ("2507211234", "001", "001", "001")]
    lenient = [tuple(r[0]) for r in df.select(fn.split_composite_id("x", strict=False)).collect()]
    assert lenient[2] == ("25072112345678", "001", "001", "001")
    assert [r[0] for r in df.select(fn.is_abnormal_long("x")).collect()] == [False, True, True, False]


# (sub, detail, expected) — the inline truth table of the reference.
ABNORMAL_CASES = [("001", "001", False), ("001", "002", True), ("002", "001", True), ("002", "002", True),
                  ("", "001", True), ("001", "", True), ("", "", True), ("abc", "001", True), ("001", "abc", True)]


def test_abnormal_subseq_truth_table(spark):
    df = spark.createDataFrame(ABNORMAL_CASES, "s string, d string, e boolean")
    got = df.select(fn.is_abnormal_subseq("s", "d").alias("g"), "e").collect()
    assert all(r["g"] == r["e"] for r in got)


def test_product_ref(spark):
    df = spark.createDataFrame([("狗糧 (DXAB12-A900XXX-7)",), ("no ref",), ("x (AB-1234)",)], "x string")
    got = [tuple(r[0]) for r in df.select(fn.product_ref_from_name("x")).collect()]
    assert got == [("DXAB12-A900XXX", "007"), (None, None), (None, None)]


def test_parse_date_multi_formats(spark):
    vals = ["2025-07-01", "2025/07/01", "2025-07-01 10:20:30", "2025/07/01 10:20:30", "2025-07-01 10:20",
            "2025/07/01 10:20", "13/07/2025", "07/13/2025", "20250701", "05/07/2025", "not a date", "", None]
    got = one_col(spark, vals, fn.parse_date_multi)
    d = dt.date
    assert got == [d(2025, 7, 1)] * 6 + [d(2025, 7, 13), d(2025, 7, 13), d(2025, 7, 1), d(2025, 7, 5), None, None, None]


def test_dash_date_and_datetime(spark):
    vals = ["2025/7/1", "2025-07-01", "2025/7/1 09:30", "", None, "2025/x/1"]
    assert one_col(spark, vals, fn.dash_date) == ["2025-07-01", "2025-07-01", "", "", "", ""]
    assert one_col(spark, vals, fn.dash_datetime) == ["2025-07-01", "2025-07-01", "2025-07-01 09:30", "", "", ""]


def test_ampm_and_ids(spark):
    assert one_col(spark, ["2025/7/6 上午 12:00:00", "2025-07-06"], fn.parse_ampm_local) == [dt.date(2025, 7, 6)] * 2
    assert one_col(spark, ["250701123", "2513xx"], fn.date_from_id_yymmdd) == ["2025-07-01", ""]
    assert one_col(spark, ["251340123"], lambda c: fn.date_from_id_yymmdd(c, strict=True)) == [None]
    assert one_col(spark, ["RM2506210008426", "RMABC"], fn.date_from_id_prefixed) == ["2025/06/21", ""]
    assert one_col(spark, ["20250615123", "2025x615"], fn.date_from_id_yyyymmdd) == [dt.date(2025, 6, 15), None]


def test_calendar_functions(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 2),), (dt.date(2021, 1, 1),)], "d date")
    r = df.select(fn.weekday_sun1("d"), fn.iso_week("d"), fn.year_month("d"), fn.weekday_label("d")).collect()
    assert [tuple(x) for x in r] == [(1, 22, "2024-06", "星期日"), (6, 53, "2021-01", "星期五")]
    mb = spark.createDataFrame([("202502",)], "m string").select(fn.month_bounds("m")).first()[0]
    assert tuple(mb) == (dt.date(2025, 2, 1), dt.date(2025, 2, 28))


def test_numbers(spark):
    vals = ["2.675", "nan", "12.0", "abc", " 3.5 ", None, "2.665"]
    assert one_col(spark, vals, fn.to_number) == [2.675, None, 12.0, None, 3.5, None, 2.665]
    assert one_col(spark, vals, fn.money2) == [Decimal("2.68"), None, Decimal("12.00"), None, Decimal("3.50"), None,
                                               Decimal("2.66")]
    assert one_col(spark, vals, fn.to_int_zero) == [2, 0, 12, 0, 3, 0, 2]
    assert one_col(spark, ["2.0", "2.50"], fn.compact_number) == ["2", "2.50"]


@pytest.mark.parametrize("text,tokens,mapped", [("Yes", True, True), ("是", True, False), ("0", False, False),
                                                (" y ", True, False), ("TRUE", True, True), (None, False, False)])
def test_booleans(spark, text, tokens, mapped):
    df = spark.createDataFrame([(text,)], "x string")
    r = df.select(fn.bool_true_tokens("x"), fn.bool_map("x"), fn.bool_equals_label("x", "是")).first()
    assert (r[0], r[1], r[2]) == (tokens, mapped, text == "是")


def test_clean_code(spark):
    assert one_col(spark, [" 471.0 ", "nan", "", None, "0012"], fn.clean_code) == ["471", None, None, None, "0012"]


def test_scale_settings():
    from orderlake.session import scale_settings
    s = scale_settings(100 << 40, 8000)          # 100 TB on 1000 executors × 8 cores
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(1 << 20, 8)["spark.sql.shuffle.partitions"] == "24"
