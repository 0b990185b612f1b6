import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake.sources import files, master, sinks
from orderlake.streaming import current_table, upsert_batch  # noqa: F401


def write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


CSV_TEXT = "訂單編號,商品名稱,數量\n25072112345678-001-001-001,狗糧,2.0\nA2,貓砂,nan\n"


def test_read_orders_legacy_encodings(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", "﻿".encode() + CSV_TEXT.encode("utf-8"))
    write(f"{tmp_dir}/in/b.csv", CSV_TEXT.encode("cp950"))
    write(f"{tmp_dir}/in/c.csv", CSV_TEXT.encode("big5"))
    enc = {r["path"].rsplit("/", 1)[-1]: r["encoding"] for r in files.detect_encoding(spark, f"{tmp_dir}/in").collect()}
    assert enc["a.csv"] == "UTF-8" and enc["b.csv"] != "UTF-8" and enc["c.csv"] != "UTF-8"
    groups = {}
    for name, e in enc.items():
        groups.setdefault(e, []).append(f"{tmp_dir}/in/{name}")
    df = files.read_orders(spark, groups)
    got = sorted((r["source_file"], r["訂單編號"], r["商品名稱"], r["數量"]) for r in df.collect())
    assert len(got) == 6
    assert {g[2] for g in got} == {"狗糧", "貓砂"}
    assert {g[3] for g in got} == {"2.0", None}            # 'nan' token -> NULL
    assert all(t == "string" for c, t in df.dtypes if c not in ("source_mtime", "source_line"))


def test_banner_tsv_utf16(spark, tmp_dir):
    body = "【※此匯出資料僅供參考】\n訂單編號\t收件人\t電話\nO1\t王\t=\"0912345678\"\nO2\t李\t\n"
    write(f"{tmp_dir}/tsv/ok.tsv", body.encode("utf-16"))
    write(f"{tmp_dir}/tsv/no_banner.tsv", "訂單編號\t收件人\nO9\t陳\n".encode("utf-16"))
    rows = files.read_banner_tsv(spark, f"{tmp_dir}/tsv", banner="【※此匯出資料")
    wide = files.pivot_banner_rows(rows, ["訂單編號", "收件人", "電話"])
    got = sorted((r["source_file"], r["訂單編號"], r["電話"]) for r in wide.collect())
    assert got == [("ok.tsv", "O1", '="0912345678"'), ("ok.tsv", "O2", "")]
    ret = files.read_banner_tsv(spark, f"{tmp_dir}/tsv", header_line=1, require_headers=["訂單", "收件"])
    assert {r["source_file"] for r in ret.collect()} == {"no_banner.tsv"}


def test_file_jobs(spark, tmp_dir):
    write(f"{tmp_dir}/f/A1102_2_1_013072_20250720163710 (1).csv", b"x,y\n1,2\n")
    write(f"{tmp_dir}/f/A1102_2_1_013072_20250720163710.csv", b"x,y\n1,2\n")
    write(f"{tmp_dir}/f/C1105_013072_20250721_104400.csv", b"x,y\n1,3\n")
    write(f"{tmp_dir}/f/backup/old.csv", b"x,y\n1,2\n")
    lst = files.list_files(spark, f"{tmp_dir}/f")
    assert lst.count() == 3
    meta = {r["name"]: r for r in files.file_metadata(lst).collect()}
    m = meta["A1102_2_1_013072_20250720163710 (1).csv"]
    assert (m["report_code"], m["delivery_code"], m["customer_code"], m["date8"], m["time6"], m["copy_no"]) == \
        ("A1102", "2", "013072", "20250720", "163710", "1")
    assert m["stem"] == "A1102_2_1_013072_20250720163710"
    assert meta["C1105_013072_20250721_104400.csv"]["date8"] == "20250721"
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{tmp_dir}/f")
    dup = files.duplicate_files(content.withColumn("length", F.col("length")))
    got = sorted((r["path"].rsplit("/", 1)[-1], r["keep"]) for r in dup.collect())
    assert [g[0] for g in got] == ["A1102_2_1_013072_20250720163710 (1).csv", "A1102_2_1_013072_20250720163710.csv",
                                   "old.csv"]
    assert sum(1 for g in got if g[1]) == 1
    newest = files.newest_version(files.file_metadata(lst), F.col("stem"))
    assert newest.count() == 2
    snap = files.latest_snapshot(lst, F.regexp_extract("name", "^([A-Z][0-9]{4})", 1), by="name")
    assert snap.count() == 2


def test_load_dimension_last_wins(spark, tmp_dir):
    doc = {"shops": [{"shop_id": "s1", "platform": "mkt-b", "shop_name": "A"},
                     {"shop_id": "s1", "platform": "mkt-b", "shop_name": "B"},
                     {"shop_id": "", "platform": "x", "shop_name": "blank"}]}
    write(f"{tmp_dir}/shops.json", json.dumps(doc).encode())
    dim = master.load_dimension(spark, f"{tmp_dir}/shops.json", "shop_id", root="shops")
    assert [(r["shop_id"], r["shop_name"]) for r in dim.collect()] == [("s1", "B")]
    bc = {"barcode_mapping": {"471": {"brand": "X"}, "472": {"brand": "Y"}}}
    write(f"{tmp_dir}/bc.json", json.dumps(bc).encode())
    m = master.dimension_from_map(spark, f"{tmp_dir}/bc.json", "barcode_mapping", key="barcode")
    assert sorted((r["barcode"], r["attrs"]["brand"]) for r in m.collect()) == [("471", "X"), ("472", "Y")]


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("o1", dt.date(2025, 7, 1), 10.5), ("o2", dt.date(2025, 8, 2), 3.0),
                                ("o2", dt.date(2025, 8, 3), 1.0), ("o3", None, 2.0)], "order_sn string, order_date date, amt double")
    n = sinks.write_table(df, f"{tmp_dir}/t", mode="truncate", partition_by=["order_sn"]).first()[0]
    assert n == 4
    try:
        sinks.write_table(df.limit(0), f"{tmp_dir}/t2")
        raise AssertionError("empty load must fail")
    except ValueError:
        pass
    assert sinks.guarded_mode(df, "order_sn", "append", on_dup="overwrite") == "truncate"
    try:
        sinks.guarded_mode(df, "order_sn", "append")
        raise AssertionError("duplicate append must fail")
    except ValueError:
        pass
    prev = sinks.load_preview(df, "order_date", "amt", "order_sn").first()
    assert (prev["rows"], str(prev["total_amount"]), prev["repeated_keys"]) == (4, "16.50", 1)
    months = sinks.monthly_export(df, "order_date", f"{tmp_dir}/m", rename={"order_sn": "訂單編號"}, order=["order_date", "order_sn"])
    assert sorted((r["year_month"], r["rows"]) for r in months.collect()) == [("2025-07", 1), ("2025-08", 2)]
    back = spark.read.option("header", "true").csv(f"{tmp_dir}/m")
    assert "訂單編號" in back.columns and back.count() == 3
    cov = sinks.date_coverage(df.filter("order_date is not null"), "order_sn", "order_date", prefix="x")
    assert {r["label"] for r in cov.collect()} == {"x_20250701_20250701", "x_20250802_20250803"}


def test_stream_fold_is_idempotent(spark, tmp_dir):
    target = f"{tmp_dir}/target"
    b1 = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("b", 1, dt.datetime(2024, 1, 1))], "k string, v int, ts timestamp")
    b2 = spark.createDataFrame([("a", 2, dt.datetime(2024, 1, 2)), ("c", 1, dt.datetime(2024, 1, 2)),
                                ("b", 9, dt.datetime(2023, 1, 1))], "k string, v int, ts timestamp")
    upsert_batch(b1, 0, target, "k", ts="ts", buckets=4)
    upsert_batch(b2, 1, target, "k", ts="ts", buckets=4)
    first = sorted(tuple(r) for r in current_table(spark, target).select("k", "v").collect())
    upsert_batch(b2, 1, target, "k", ts="ts", buckets=4)          # replayed micro-batch
    again = sorted(tuple(r) for r in current_table(spark, target).select("k", "v").collect())
    assert first == again == [("a", 2), ("b", 1), ("c", 1)]
    from orderlake.streaming import compact_epochs
    assert compact_epochs(spark, target) > 0
    after = sorted(tuple(r) for r in current_table(spark, target).select("k", "v").collect())
    assert after == first


def test_write_modes_and_archive_layout(spark, tmp_dir):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("sales", "2025", "07", "o1", "1"), ("ship", "2025", "08", "o2", "x")],
                               "report_type string, year string, month string, order_sn string, qty string")
    schema = T.StructType([T.StructField("report_type", T.StringType()), T.StructField("year", T.StringType()),
                           T.StructField("month", T.StringType()), T.StructField("order_sn", T.StringType()),
                           T.StructField("qty", T.LongType()), T.StructField("note", T.StringType())])
    path = f"{tmp_dir}/archive"
    assert sinks.write_table(df.withColumn("qty", F.col("qty").try_cast("bigint")), path, mode="empty", schema=schema,
                             partition_by=["report_type", "year", "month"]).first()[0] == 2
    assert os.path.isdir(f"{path}/report_type=ship/year=2025/month=08")
    try:
        sinks.write_table(df, path, mode="empty")
        raise AssertionError("EMPTY mode must refuse an existing table")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)
    assert sinks.write_table(df.withColumn("qty", F.lit(1).cast("bigint")), path, mode="append", schema=schema,
                             partition_by=["report_type", "year", "month"]).first()[0] == 4
    back = spark.read.parquet(path)
    assert back.filter("note is null").count() == 4 and dict(back.dtypes)["qty"] == "bigint"


def test_read_orders_quarantines_malformed_lines(spark, tmp_dir):
    write(f"{tmp_dir}/q/a.csv", "訂單編號,數量\nA1,2\nA2,3,extra,fields\nA3,4\n".encode())
    df = files.read_orders(spark, {"UTF-8": [f"{tmp_dir}/q/a.csv"]}, columns=["訂單編號", "數量"])
    good, bad = files.quarantine(df.cache())
    assert sorted(r["訂單編號"] for r in good.collect()) == ["A1", "A3"]
    b = bad.collect()
    assert len(b) == 1 and b[0]["_corrupt_record"].startswith("A2,3,extra") and b[0]["source_file"] == "a.csv"


def test_each_file_keeps_its_own_header(spark, tmp_dir):
    """Other column orders, other columns, repeated and blank names, quoted line
    breaks (read as line feeds); rows are united by name and keep their place in the file."""
    write(f"{tmp_dir}/h/a.csv", "編號,name\r\n1,甲\r\n2,\"乙\r\n丙\"\r\n".encode())
    write(f"{tmp_dir}/h/b.csv", "name,編號,extra\nbb,3,x\n".encode("cp950"))
    write(f"{tmp_dir}/h/c.csv", "編號,編號,,name\n4,5,6,7\n".encode("utf-16"))
    write(f"{tmp_dir}/h/bad.csv", "編號,name\n1,".encode() + b"\xff\x81\xff\xfe\x80\n")
    write(f"{tmp_dir}/h/empty.csv", b"")
    rows, report = files.read_reports(spark, f"{tmp_dir}/h", glob="*.csv")
    assert rows.columns[:5] == ["編號", "name", "extra", "編號.1", "Unnamed: 2"]
    got = sorted((r["編號"], r["name"], r["extra"], r["編號.1"], r["Unnamed: 2"], r["source_line"]) for r in rows.collect())
    assert got == [("1", "甲", None, None, None, 1), ("2", "乙\n丙", None, None, None, 2), ("3", "bb", "x", None, None, 1),
                   ("4", "7", None, "5", "6", 1)]
    readable = {r["name"]: r["readable"] for r in report.collect()}
    assert readable["bad.csv"] is False and readable["a.csv"] and readable["b.csv"] and readable["c.csv"]


def test_split_reads_keep_the_order_of_lines(spark, tmp_dir):
    lines = [f"{k},{'v' * (k % 50)}" for k in range(4000)]
    write(f"{tmp_dir}/s/a.csv", ("k,v\n" + "\n".join(lines)).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        rows = files.read_orders(spark, {"UTF-8": [f"{tmp_dir}/s/a.csv"]}, null_tokens=False)
        got = [r["k"] for r in rows.orderBy("source_line").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [str(k) for k in range(4000)]


def test_bucket_count_is_kept_with_the_target(spark, tmp_dir):
    batch = spark.createDataFrame([(k, k) for k in range(50)], "k bigint, ts bigint")
    upsert_batch(batch, 0, f"{tmp_dir}/t", "k", ts="ts", buckets=4)
    with pytest.raises(ValueError):
        upsert_batch(batch, 1, f"{tmp_dir}/t", "k", ts="ts", buckets=64)
    assert current_table(spark, f"{tmp_dir}/t").count() == 50
    assert current_table(spark, f"{tmp_dir}/none").count() == 0


def test_csv_mark_and_coverage_fallback(spark, tmp_dir):
    from orderlake.sources import sinks
    df = spark.createDataFrame([("訂1", "x"), ("訂2", "y")], ["編號", "v"])
    assert sinks.write_table(df, f"{tmp_dir}/bom", fmt="csv", header="true", bom=True, sort_within=["編號"]).first()[0] == 2
    parts = [f for f in os.listdir(f"{tmp_dir}/bom") if f.endswith(".csv")]
    assert all(open(f"{tmp_dir}/bom/{f}", "rb").read().startswith(b"\xef\xbb\xbf") for f in parts)
    back = files.read_orders(spark, {"UTF-8": [f"{tmp_dir}/bom"]})
    assert sorted(r["編號"] for r in back.collect()) == ["訂1", "訂2"]
    d = spark.createDataFrame([("a", "2025-07-01"), ("a", "2025-07-03"), ("orders_20250105.csv", None), ("x", None)], "f string, d string")
    name = F.regexp_extract("f", "([0-9]{8})", 1)
    got = {r["f"]: r["label"] for r in sinks.date_coverage(d, "f", "d", fallback=[name, F.lit("20250801_120000")]).collect()}
    assert got == {"a": "orders_20250701_20250703", "orders_20250105.csv": "orders_20250105", "x": "orders_20250801_120000"}


def test_compaction_then_more_batches(spark, tmp_dir):
    """Base plus later epochs, a replay of the last batch, and a second compaction."""
    from orderlake.streaming import compact_epochs
    schema = "k bigint, v bigint"
    batch = lambda lo, hi, v: spark.createDataFrame([(k, v) for k in range(lo, hi)], schema)     # noqa: E731
    got = lambda: sorted(map(tuple, current_table(spark, f"{tmp_dir}/c").select("k", "v").collect()))
    for epoch, (lo, hi) in enumerate([(0, 30), (10, 40)]):
        upsert_batch(batch(lo, hi, epoch), epoch, f"{tmp_dir}/c", "k", buckets=4)
    want = [(k, 0 if k < 10 else 1) for k in range(40)]
    assert got() == want and compact_epochs(spark, f"{tmp_dir}/c") == 2 and got() == want
    upsert_batch(batch(10, 40, 1), 1, f"{tmp_dir}/c", "k", buckets=4)                          # replayed
    assert got() == want
    upsert_batch(batch(35, 50, 2), 2, f"{tmp_dir}/c", "k", buckets=4)
    want = [(k, 0 if k < 10 else 1 if k < 35 else 2) for k in range(50)]
    assert got() == want and compact_epochs(spark, f"{tmp_dir}/c") > 0 and got() == want


def test_mark_before_quoted_headers(spark, tmp_dir):
    df = spark.createDataFrame([("訂1", 'x "y",\nz', None), ("訂2", "", 5)], "`編號` string, v string, n int")
    out = sinks.write_table(df.coalesce(1), f"{tmp_dir}/q", fmt="csv", header="true", quoteAll="true", bom=True, multiLine="true")
    assert out.first()[0] == 2
    part = next(f for f in os.listdir(f"{tmp_dir}/q") if f.endswith(".txt"))
    assert open(f"{tmp_dir}/q/{part}", "rb").read().decode() == '﻿"編號","v","n"\n"訂1","x ""y"",\nz",""\n"訂2","","5"\n'
    with pytest.raises(ValueError):
        sinks.write_table(df, f"{tmp_dir}/p", fmt="csv", header="true", quoteAll="true", bom=True, partition_by=["n"])
