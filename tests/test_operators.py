import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlake.operators import calendar as cal
from orderlake.operators import conform as cf
from orderlake.operators import dedupe, enrich, headers, quality, reconcile
from orderlake.operators import sequence as sq
from orderlake.operators import upsert as up


def _key(t):
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_keep_last_first_null_keys_and_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n1"), (None, 7, "n2"), ("b", None, "q"), ("b", 1, "r")],
        "k string, seq int, v string")
    assert rows(dedupe.keep_last(df, "k", "seq"), "k", "v") == [(None, "n2"), ("a", "z"), ("b", "r")]
    assert rows(dedupe.keep_first(df, "k", "seq"), "k", "v") == [(None, "n1"), ("a", "x"), ("b", "q")]


def test_dedupe_idempotent_and_key_unique(spark):
    li = spark.range(0, 2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("seq"),
                                     (F.col("id") * 7 % 11).alias("v"))
    once = dedupe.keep_last(li, "k", "seq")
    twice = dedupe.keep_last(once, "k", "seq")
    assert once.count() == once.select("k").distinct().count() == 37
    assert once.exceptAll(twice).count() == 0


def test_dedupe_empty_input(spark):
    df = spark.createDataFrame([], "k string, seq int")
    assert dedupe.keep_last(df, "k", "seq").count() == 0
    assert dedupe.duplicate_stats(df, "k").first()["total_rows"] == 0


def test_keep_priority_and_latest(spark):
    df = spark.createDataFrame([("o1", "A1102_3", 1), ("o1", "A1102_2", 2), ("o2", "zzz", 3), ("o2", "A1102_3", 4)],
                               "k string, src string, seq int")
    out = dedupe.keep_priority(df, "k", "src", {"A1102_2": 2, "A1102_3": 1}, "seq")
    assert rows(out, "k", "src") == [("o1", "A1102_2"), ("o2", "A1102_3")]
    ev = spark.createDataFrame([("k", None, 9), ("k", dt.datetime(2024, 1, 2), 1), ("k", dt.datetime(2024, 1, 1), 5)],
                               "k string, ts timestamp, seq int")
    assert rows(dedupe.keep_latest(ev, "k", "ts", "seq"), "seq") == [(1,)]


def test_duplicate_statistics(spark):
    df = spark.createDataFrame([(1, "s1"), (1, "s2"), (1, "s1"), (2, "s1"), (3, "s3"), (3, "s3")], "k int, src string")
    st = dedupe.duplicate_stats(df, "k").first().asDict()
    assert st == {"total_rows": 6, "distinct_keys": 3, "surplus_rows": 3, "repeated_keys": 2, "max_multiplicity": 3}
    assert rows(dedupe.top_duplicates(df, "k", 1), "k", "n") == [(1, 3)]
    assert rows(dedupe.duplicates_by_source(df, "k", "src"), "k", "src", "n") == [(1, "s1", 2), (1, "s2", 1), (3, "s3", 2)]


def test_upsert_idempotent_and_newer_wins(spark):
    old = spark.createDataFrame([("a", "2025-07-01", 1.0), ("b", "2025-07-02", 2.0), ("c", "", 3.0)],
                                "k string, d string, v double")
    new = spark.createDataFrame([("b", "2025-07-02", 20.0), ("d", "2025-07-03", 4.0)], "k string, d string, v double")
    once = up.upsert(old, new, "k", require="d")
    assert rows(once, "k", "v") == [("a", 1.0), ("b", 20.0), ("d", 4.0)]
    assert up.upsert(once, new, "k", require="d").exceptAll(once).count() == 0


def test_upsert_with_timestamp_and_missing_column(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")           # old table without import time
    new = spark.createDataFrame([("a", 2, dt.datetime(2024, 1, 1)), ("a", 3, dt.datetime(2025, 1, 1))],
                                "k string, v int, imported timestamp")
    out = up.upsert(old.withColumn("imported", F.lit(dt.datetime(2024, 1, 1))), new, "k", ts="imported")
    assert rows(out, "k", "v") == [("a", 3)]


def test_priority_union_and_membership(spark):
    top = spark.createDataFrame([("o1", "A"), ("o2", "A")], "k string, v string")
    low = spark.createDataFrame([("o2", "B"), ("o3", "B")], "k string, v string")
    out = up.priority_union([top, low], "k", source_col="src", labels=["A1102_2", "A1102_3"])
    assert rows(out, "k", "src") == [("o1", "A1102_2"), ("o2", "A1102_2"), ("o3", "A1102_3")]
    assert rows(up.member_of(low, top, "k", negate=True), "k") == [("o3",)]


def test_number_within_matches_window_and_handles_hot_group(spark):
    df = spark.range(0, 3000).select((F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id") % 50)).alias("g"),
                                     (F.col("id") * 7919 % 3001).alias("o"), F.col("id"))
    got = sq.number_within(df, "g", ["o"], out="seq", pad=3, partitions=6)
    w = Window.partitionBy("g").orderBy("o", "id")
    ref = df.withColumn("seq", F.row_number().over(w).cast("bigint"))
    assert got.select("g", "o", "id", "seq").exceptAll(ref).count() == 0
    assert got.filter("g = 0").agg(F.max("seq")).first()[0] == 2000 + 20
    assert got.filter("seq = 7").select("seq_text").first()[0] == "007"


def test_global_sequence(spark):
    df = spark.range(0, 500).select((F.col("id") * 37 % 500).alias("x"))
    got = sq.global_sequence(df, ["x"], partitions=4)
    assert got.filter(F.col("seq") != F.col("x") + 1).count() == 0


def test_consecutive_runs_reference_cases(spark):
    data = [("2025-06-21", "Amy", "RM2506210008426"), ("2025-06-21", "Amy", "RM2506210008427"),
            ("2025-06-21", "Amy", "RM2506210008428"), ("2025-06-21", "Amy", "RM2506210008430"),
            ("2025-06-21", "Amy", "RMABC"), ("2025-06-21", "Amy", ""), ("2025-06-21", "Bob", "RM2506210008431"),
            ("2025-06-22", "Amy", "RM2506210008429")]
    df = spark.createDataFrame(data, "d string, r string, sn string")
    got = {(r["r"], r["sn"]): r["n"] for r in sq.consecutive_runs(df, "d", "r", "sn", out="n", partitions=3).collect()}
    # sorted by (date, recipient, text id): '' < 'RM…426' < … < 'RMABC'
    assert got[("Amy", "")] == "1"
    assert got[("Amy", "RM2506210008426")] == "2"        # blank id before continues the run
    assert got[("Amy", "RM2506210008427")] == "3"
    assert got[("Amy", "RM2506210008428")] == "4"
    assert got[("Amy", "RM2506210008430")] == "1"        # gap
    assert got[("Amy", "RMABC")] == "1"                  # unparsable id
    assert got[("Bob", "RM2506210008431")] == "1"        # new recipient
    assert got[("Amy", "RM2506210008429")] == "1"        # new date


def test_missing_days_ranges_completeness(spark):
    days = ["2025-07-01", "2025-07-02", "2025-07-04", "2025-07-08", "2025-07-09"]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.to_date("d"))
    miss = cal.missing_days(df, "d")
    assert rows(miss, "day") == [(dt.date(2025, 7, 3),), (dt.date(2025, 7, 5),), (dt.date(2025, 7, 6),),
                                 (dt.date(2025, 7, 7),)]
    rng = cal.missing_ranges(miss)
    assert rows(rng, "label", "n_days") == [("2025-07-03", 1), ("2025-07-05~2025-07-07", 3)]
    c = cal.completeness(df, "d").first()
    assert (c["total_days"], c["missing_days"], str(c["completeness_pct"])) == (9, 4, "55.6")
    # missing ∪ present = calendar
    assert miss.select("day").union(df.select(F.col("d").alias("day"))).distinct().count() == 9


def test_missing_counterpart_excludes_cancelled(spark):
    o = spark.createDataFrame([("o1", "2025-07-01", None, "ok"), ("o2", "2025-07-01", None, "已取消"),
                               ("o3", "2025-07-02", None, None), ("o4", "2025-07-02", "c", "ok")],
                              "k string, d string, cust string, status string")
    ship = spark.createDataFrame([("o4",)], "k string")
    miss = cal.missing_counterpart(o, ship, "k", exclude_status="取消|退貨", status="status", date="d")
    assert rows(miss, "k") == [("o1",), ("o3",)]
    assert rows(cal.missing_by_day(miss, "d", "k"), "day", "n_orders") == [(dt.date(2025, 7, 1), 1), (dt.date(2025, 7, 2), 1)]


def test_reconcile_full_outer_with_suffix_and_coalesce(spark):
    sales = spark.createDataFrame([("1_01", "", "A"), ("1_02", "2025-07-01", "B")], "uid string, order_date string, name string")
    ship = spark.createDataFrame([("1_01", "2025-07-03", "a"), ("2_01", "2025-07-04", "c")], "uid string, order_date string, name string")
    out = reconcile.reconcile(sales, ship, "uid", coalesce_cols={"order_date_final": ("order_date", "order_date")})
    assert set(out.columns) >= {"uid", "order_date", "order_date_shipping", "name_shipping", "source"}
    assert rows(out, "uid", "order_date_final", "source") == [("1_01", "2025-07-03", "both"),
                                                             ("1_02", "2025-07-01", "left_only"),
                                                             ("2_01", "2025-07-04", "right_only")]
    cov = reconcile.key_coverage(sales, ship, "uid")
    assert rows(cov, "coverage", "n_keys") == [("both", 1), ("left_only", 1), ("right_only", 1)]


def test_enrich_overwrite_fill_longer(spark):
    fact = spark.createDataFrame([("b1", "own", "x"), ("b2", "keep", "y"), ("b3", "none", "z")], "code string, name string, brand string")
    dim = spark.createDataFrame([("b1", "Master One", None, 1), ("b1", "Master Last", "BR", 2), ("b2", None, "B2", 3)],
                                "code string, name string, brand string, pos int")
    ow = enrich.overwrite(fact, dim, "code", ["name", "brand"], position="pos")
    assert rows(ow, "code", "name", "brand") == [("b1", "Master Last", "BR"), ("b2", "keep", "B2"), ("b3", "none", "z")]
    fl = enrich.fill(fact.select("code"), dim, "code", ["name"], prefix="m_", position="pos", flag="hit")
    assert rows(fl, "code", "m_name", "hit") == [("b1", "Master Last", True), ("b2", "", True), ("b3", "", False)]
    df = spark.createDataFrame([("ab", "abc"), ("abcd", "abc"), ("", "x"), ("q", None)], "o string, m string")
    assert [r[0] for r in df.select(enrich.prefer_longer("o", "m")).collect()] == ["abc", "abcd", "x", "q"]


def test_lookup_cascade_stages(spark):
    master = spark.createDataFrame(
        [("4710001112223", 1), ("000093766217126", 2), ("937662171200000", 3), ("12345678901234", 4),
         ("120000000000000", 5), ("00012345678", 6), ("88880000", 7), ("88880000123", 8), ("88880000124", 9),
         ("0000055555", 10)], "k string, pos int")
    codes = ["4710001112223", "93766217126", "9376621712", "12", "0012345678", "12345678", "888800001",
             "88880000999", "55555", "4710001112223.0", "", "nan", "zzz", None]
    fact = spark.createDataFrame([(c,) for c in codes], "code string")
    # a code that is a prefix of a master key
    fact = fact.union(spark.createDataFrame([("8888000012",)], "code string"))
    got = {r["code"]: (r["m"], r["s"]) for r in enrich.lookup_cascade(fact, master, "code", "k", "pos", out="m", stage="s").collect()}
    assert got["4710001112223"] == ("4710001112223", 1)
    assert got["4710001112223.0"] == ("4710001112223", 1)
    assert got["93766217126"] == ("000093766217126", 2)          # left pad 15
    assert got["9376621712"] == ("937662171200000", 3)           # right pad 15
    assert got["12"] == ("120000000000000", 3)
    assert got["0012345678"] == ("00012345678", 6 + 2)           # left pad 11
    assert got["888800001"] == ("88880000", 18)                  # first master key (file order) either way
    assert got["888800001"] != ("88880000123", 18)
    assert got["88880000999"] == ("88880000", 18)                # master key is a prefix of the code
    assert got["55555"] == ("0000055555", 6)                     # left pad 10
    assert got["8888000012"] == ("88880000", 18)
    assert got[""] == (None, None) and got["nan"] == (None, None) and got["zzz"] == (None, None)


def test_lookup_multi_casefold_attach(spark):
    master = spark.createDataFrame([("111",), ("222",)], "k string")
    fact = spark.createDataFrame([("x", "222", "111"), ("111", "x", "x"), ("x", "x", "x")], "a string, b string, c string")
    assert [r["m"] for r in enrich.lookup_multi(fact, master, "k", ["a", "b", "c"], out="m").orderBy("a", "b").collect()] == \
        ["111", "222", None]
    shops = spark.createDataFrame([("MktB", "s1", 1), ("mktb ", "s2", 2), ("MktC", "s3", 3)], "platform string, shop_id string, pos int")
    f = spark.createDataFrame([(" MKTB",), ("mktc",), ("other",)], "platform string")
    out = enrich.casefold_join(f, shops, "platform", "platform", ["shop_id"], "pos")
    assert rows(out, "platform", "shop_shop_id") == [(" MKTB", "s2"), ("mktc", "s3"), ("other", None)]
    att = enrich.attach_single(f, shops, F.col("platform") == "MktC", ["shop_id"], prefix="shop_")
    assert {r["shop_shop_id"] for r in att.collect()} == {"s3"}
    none = enrich.attach_single(f, shops, F.col("platform") == "none", ["shop_id"], defaults={"shop_id": "?"})
    assert {r["shop_id"] for r in none.collect()} == {"?"}


def test_match_rate(spark):
    df = spark.createDataFrame([(True,), (False,), (True,), (None,)], "m boolean")
    r = enrich.match_rate(df, "m").first()
    assert (r["rows"], r["matched"], r["unmatched"], str(r["matched_pct"])) == (4, 2, 2, "50.00")


def test_quality_profiles(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "x", None), (3, None, "a")], "id int, s string, t string")
    npf = quality.null_profile(df)
    assert rows(npf, "column", "null_count") == [("s", 2), ("t", 1)]
    prof = {r["column"]: r for r in quality.profile(df).collect()}
    assert prof["t"]["distinct_values"] == 1 and prof["id"]["non_null"] == 3 and prof["id"]["data_type"] == "int"
    vc = quality.value_counts(df, "t")
    assert [tuple(r) for r in vc.collect()] == [("a", 2), (None, 1)]
    ch = quality.changed_cells(df, {"s": F.upper("s"), "t": F.col("t")})
    assert rows(ch, "column", "changed_cells") == [("*total*", 1), ("s", 1), ("t", 0)]
    sc = quality.step_counts([("drop", df, df.filter("id > 1"))])
    assert rows(sc, "step", "rows_out", "removed") == [("*total*", 2, 1), ("drop", 2, 1)]


def test_conform_and_registry(spark):
    reg = cf.registry_from_rows([
        {"order": 2, "name": "qty", "local_name": "數量", "type": "INTEGER"},
        {"order": 1, "name": "sn", "local_name": "訂單編號", "type": "STRING", "required": "是"},
        {"order": 3, "name": "paid", "local_name": "已付款", "type": "BOOLEAN"},
        {"order": 4, "name": "day", "local_name": "日期", "type": "DATE"},
        {"order": 5, "name": "amt", "local_name": "金額", "type": "NUMERIC"},
        {"name": "", "type": "STRING"}, {},
        {"order": 6, "name": "qty", "local_name": "數量2", "type": "FLOAT"},   # later duplicate wins
    ])
    assert [f.name for f in reg] == ["sn", "paid", "day", "amt", "qty"]
    raw = spark.createDataFrame([("A1", "2.0", "是", "2025/7/1", "12.345", "extra")],
                                "`訂單編號` string, `數量2` string, `已付款` string, `日期` string, `金額` string, x string")
    named = cf.registry_rename(raw, reg)
    out = cf.conform(named, reg, extras="last")
    r = out.first()
    assert out.columns == ["sn", "paid", "day", "amt", "qty", "x"]
    assert (r["sn"], r["qty"], r["paid"], r["day"], str(r["amt"])) == ("A1", 2.0, True, dt.date(2025, 7, 1), "12.34")
    assert cf.validate_headers(["sn"], reg) == {"ok": True, "missing": [], "extra": []}
    assert cf.validate_headers(["x"], reg)["ok"] is False
    assert cf.sanitize_names(["Order No.", "1st", "a-b", "a_b", "(x)"]) == ["order_no_", "col_1st", "a_b", "a_b_1", "x"]
    st = cf.stamp(out, always={"platform": "m"}, if_blank={"sn": "zz", "note": "n"}).first()
    assert (st["platform"], st["sn"], st["note"]) == ("m", "A1", "n")
    fb = cf.fallback_column(spark.createDataFrame([("", "台北")], "receiver_addr string, `配送地址 address` string"),
                            "receiver_addr", "address")
    assert fb.first()["receiver_addr"] == "台北"


def test_header_matching(spark):
    hdr = spark.createDataFrame([("f", 0, "重量（公斤）"), ("f", 1, "ＯＲＤＥＲ＿ＩＤ"), ("f", 2, "product nane"),
                                 ("f", 3, "unrelated"), ("g", 0, "收件人 地址\n詳細資料")],
                                "file string, position int, header string")
    reg = spark.createDataFrame([("weight", "重量", 1), ("order_id", "order id", 2), ("product_name", "product name", 3),
                                 ("addr", "收件人 地址詳細", 4)], "name string, local_name string, reg_order int")
    fz = {r["position"]: (r["name"], r["how"]) for r in headers.match_fuzzy(hdr.filter("file = 'f'"), reg).collect()}
    assert fz[0] == ("weight", "exact") and fz[1] == ("order_id", "exact") and fz[2] == ("product_name", "fuzzy")
    assert 3 not in fz
    ct = {(r["file"], r["position"]): (r["name"], r["stage"]) for r in headers.match_contains(hdr, reg).collect()}
    assert ct[("g", 0)] == ("addr", 3)


def test_classify_reports(spark):
    h = spark.createDataFrame([("orders_x.csv", ["a", "b"]), ("f2", ["退貨單號", "退貨單序號", "x"]), ("f3", ["q"])],
                              "file string, header_list array<string>")
    out = headers.classify_reports(h, {"retgood": ["退貨單號", "退貨單序號"]}, {"orders_": "orders"}, min_hits=2)
    assert rows(out, "file", "report_type") == [("f2", "retgood"), ("f3", "unknown"), ("orders_x.csv", "orders")]


def test_ordering_and_requirements(spark):
    from orderlake.operators import ordering as od
    df = spark.createDataFrame([("10",), ("9",), ("x",), ("100",)], "sn string")
    assert [r[0] for r in od.sort_numeric(df, "sn").collect()] == ["9", "10", "100", "x"]
    ids = spark.createDataFrame([("RM2506210008428", True), ("RMABC", False), ("RM2506210008426", True), ("", True)],
                                "sn string, ok boolean")
    got = [r[0] for r in od.sort_prefixed_id(ids, "sn", "RM", invalid=~F.col("ok")).collect()]
    assert got == ["", "RM2506210008426", "RM2506210008428", "RMABC"]
    assert [r[0] for r in od.head(df, 2, "sn").collect()] == ["10", "100"]
    assert [r[0] for r in od.valid_invalid_split(ids, F.col("ok"), "sn").collect()][-1] == "RMABC"
    q = spark.createDataFrame([("a", "2025-07-01"), (" ", "2025-07-02"), (None, "x"), ("b", "")], "k string, d string")
    assert quality.require_key(q, "k").count() == 2
    assert quality.require_date(quality.require_key(q, "k"), "d").count() == 1
    from orderlake import functions as fn
    assert quality.require_date(q, "d", fn.parse_date_multi("d")).count() == 2
    assert sorted(r[0] for r in quality.distinct_values(q, "d").collect()) == ["", "2025-07-01", "2025-07-02", "x"]


def test_suppress_duplicates_stream(spark, tmp_dir):
    import os
    from orderlake.streaming import suppress_duplicates
    src = f"{tmp_dir}/ev"
    os.makedirs(src)
    spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 0, 0)), (1, "a", dt.datetime(2024, 1, 1, 0, 5)),
                           (2, "a", dt.datetime(2024, 1, 1, 0, 1))], "u long, t string, ts timestamp") \
        .write.mode("overwrite").parquet(f"{src}/b1")
    stream = spark.readStream.schema("u long, t string, ts timestamp").parquet(f"{src}/b1")
    q = (suppress_duplicates(stream, ["u", "t"], "ts", "1 hour").writeStream.format("memory")
         .queryName("suppressed").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from suppressed").first()[0] == 2


def test_window_and_scan_methods_agree(spark):
    df = spark.range(0, 800).select((F.col("id") % 13).alias("g"), (F.col("id") * 31 % 97).alias("o"), "id")
    a = sq.number_within(df, "g", ["o"], partitions=4)
    b = sq.number_within(df, "g", ["o"], method="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ids = spark.range(0, 400).select(
        (F.col("id") % 3).cast("string").alias("d"), (F.col("id") % 2).cast("string").alias("r"),
        F.when(F.col("id") % 17 == 0, F.lit("RMX")).when(F.col("id") % 19 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("RM"), (F.col("id") - F.col("id") % 5).cast("string"))).alias("sn"),
        "id")
    x = sq.consecutive_runs(ids, "d", "r", "sn", partitions=4)
    y = sq.consecutive_runs(ids, "d", "r", "sn", method="window")
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_schema_helpers():
    from pyspark.sql import types as T
    cols = ["shop_name", "x", "product_sku", "order_date", "order_time", "data_import_timestamp", "product_name"]
    assert cf.order_columns(cols, first=["order_date", "order_time"], prefixes=["product_", "shop_"],
                            last=["data_import_timestamp"]) == \
        ["order_date", "order_time", "product_sku", "product_name", "shop_name", "x", "data_import_timestamp"]
    rules = [(r"(^|_)(qty|quantity)$", "INTEGER"), (r"(price|cost|amount)", "NUMERIC"), (r"_date$", "DATE")]
    assert [cf.type_for_name(n, rules) for n in ["order_qty", "unit_price", "order_date", "note"]] == \
        ["INTEGER", "NUMERIC", "DATE", "STRING"]
    reg = cf.registry_from_rows([{"order": 1, "name": "a", "type": "NUMERIC"}, {"order": 2, "name": "b", "type": "DATETIME"},
                                 {"order": 3, "name": "c", "type": "whatever"}])
    assert cf.schema_for(reg) == T.StructType([T.StructField("a", T.DecimalType(18, 2)),
                                               T.StructField("b", T.TimestampNTZType()),
                                               T.StructField("c", T.StringType())])


def test_lookup_multi_shuffle_path_matches_broadcast_path(spark):
    master = spark.createDataFrame([(f"{i:05d}",) for i in range(0, 300, 3)], "k string")
    fact = spark.range(0, 400).select(
        F.lpad((F.col("id") * 7 % 311).cast("string"), 5, "0").alias("a"),
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.lpad((F.col("id") % 300).cast("string"), 5, "0")).alias("b"),
        F.concat(F.lpad((F.col("id") % 150).cast("string"), 5, "0"), F.lit(".0")).alias("c"), "id")
    small = enrich.lookup_multi(fact, master, "k", ["a", "b", "c"], out="m")
    large = enrich.lookup_multi(fact, master, "k", ["a", "b", "c"], out="m", max_rows=10)   # forces the shuffle path
    assert small.columns == large.columns
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert small.filter("m is not null").count() > 0


def test_number_within_auto_picks_a_plan(spark):
    df = spark.range(0, 500).select((F.col("id") % 5).alias("g"), "id")
    ref = sq.number_within(df, "g", ["id"], method="window")
    for limit in (10, 1_000):                       # 10 -> scan, 1000 -> window
        got = sq.number_within(df, "g", ["id"], method="auto", max_group_rows=limit, partitions=3)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_apply_settings_respects_explicit_conf(spark):
    from orderlake.session import apply_settings, scale_settings
    before = spark.conf.get("spark.sql.shuffle.partitions")
    explicit = dict(spark.sparkContext.getConf().getAll())
    s = scale_settings(1 << 30, 8)
    apply_settings(spark, {"spark.sql.shuffle.partitions": s["spark.sql.shuffle.partitions"],
                           "spark.sql.adaptive.advisoryPartitionSizeInBytes": s["spark.sql.adaptive.advisoryPartitionSizeInBytes"]})
    try:
        if "spark.sql.shuffle.partitions" in explicit:           # set by the session builder: untouched
            assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_numbering_keeps_every_value_and_agrees(spark):
    """NaN, the last timestamp and NULL keys survive; both plans give one result."""
    rows = [("a", float("nan"), "9999-12-31 23:59:59", None), ("a", 1.0, None, 5), (None, None, None, None), ("b", -0.0, "1970-01-01", 7),
            ("a", float("nan"), "2020-01-01", 9)]
    df = spark.createDataFrame(rows, "g string, x double, t string, n bigint").withColumn("t", F.to_timestamp("t"))
    one = sq.number_within(df, "g", ["x"], out="seq", partitions=3)
    two = sq.number_within(df, "g", ["x"], out="seq", method="window")
    key = lambda r: str(r)                                                         # noqa: E731
    assert sorted(one.collect(), key=key) == sorted(two.collect(), key=key) or \
        sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert one.filter("t > timestamp'9999-12-30'").count() == 1 and one.filter("isnan(x)").count() == 2


def test_runs_of_long_and_signed_ids(spark):
    big = 10 ** 45 - 2
    ids = [f"RM{big + k}" for k in range(4)] + [f"RM{k}" for k in (-2, -1, 0, 1)] + ["RM007", "RM8", "x", "", None]
    df = spark.createDataFrame([("d", str(len(i or "")) if i and len(i) > 9 else "s", i) for i in ids], "d string, r string, sn string")
    a = {r["sn"]: r["n"] for r in sq.consecutive_runs(df, "d", "r", "sn", out="n", partitions=2).collect()}
    b = {r["sn"]: r["n"] for r in sq.consecutive_runs(df, "d", "r", "sn", out="n", method="window").collect()}
    assert a == b
    assert [a[f"RM{big + k}"] for k in range(4)] == ["1", "2", "1", "2"]      # the recipient changes with the length
    assert a["RM8"] == "1" and a["x"] == "1"


def test_unique_names_for_any_collision():
    got = cf.sanitize_names(["a", "a", "a_1", "編號", "【x】", "9", "", "A"])
    assert len(set(got)) == len(got) and got[3] == "編號" and got[4] == "x" and got[5] == "col_9" and "a_1" in got


def test_fuzzy_scores_only_pairs_with_common_characters(spark, monkeypatch):
    from collections import Counter
    from difflib import SequenceMatcher
    import random
    rng = random.Random(5)
    bits = ["an", "the", "in", "ou", "re", "ti", "on", "sh", "ed", "上午"]
    words = sorted({"".join(rng.choice(bits) for _ in range(rng.randint(3, 6))) for _ in range(400)})
    heads, names = words[::2], words[1::2]
    h = spark.createDataFrame([("f", k, x) for k, x in enumerate(heads)], "file string, position long, header string")
    reg = spark.createDataFrame([(x, x, k) for k, x in enumerate(names)], "name string, local_name string, reg_order long")
    scored, dealt = [], headers._dealt
    monkeypatch.setattr(headers, "_dealt", lambda pairs, *a: scored.extend(pairs.collect()) or dealt(pairs, *a))
    got = {r["name"]: (r["header"], r["score"]) for r in headers.match_fuzzy(h, reg).collect()}
    want = {}
    for y in names:
        score, k = max((SequenceMatcher(None, x, y).ratio(), -k) for k, x in enumerate(heads))
        if score > 0.85:
            want[y] = (heads[-k], score)
    assert got == want and got
    # most pairs that share bigrams have too few characters in common; 64 bits let some through
    vain = [r for r in scored if 2 * sum((Counter(r["__hn"]) & Counter(r["__rn"])).values())
            <= 0.85 * (len(r["__hn"]) + len(r["__rn"]))]
    assert 2 * len(vain) < len(scored), (len(vain), len(scored))
