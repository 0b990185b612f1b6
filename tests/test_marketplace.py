"""End-to-end flows over generated raw report files (FIXTURES.md §2)."""

import csv
import datetime as dt
import io
import os
import time


from orderlake.operators import conform as cf
from orderlake.plans import marketplace as mp


def write_csv(path, header, rows, encoding="utf-8", bom=False, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(header)
    w.writerows(rows)
    data = buf.getvalue().encode(encoding)
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + data)
    if mtime:
        os.utime(path, (mtime, mtime))


SALES_H = ["訂單日期", "訂單編號", "項次", "配送狀態", "訂單狀態", "商品屬性", "銷售編號", "子商品銷售編號", "子商品商品編號",
           "配送方式", "商品名稱", "顏色", "款式", "售價", "成本", "數量", "通路", "配送確認日", "公司"]
SHIP_H = ["訂單號碼", "訂單項次", "併單序號", "送貨單號", "銷售編號", "商品編號", "商品名稱", "顏色", "款式", "廠商商品號碼",
          "訂單類別", "數量", "售價", "成本", "客戶名稱", "客戶電話", "室內電話", "配送地址", "貨運公司", "配送單號",
          "出貨指示日", "要求配送日", "要求配送時間", "備註", "贈品", "廠商配送訊息", "預計入庫日", "預計配送日", "通路別",
          "訂單類別代號", "公司別"]


def sales_row(date, sn, item, name, price, qty):
    return [date, sn, item, "已出貨", "正常", "", "S1", "", "", "宅配", name, "紅", "L", price, "80", qty, "電視", "", "X"]


def ship_row(sn, item, phone, note, code, date, stockin):
    r = [""] * len(SHIP_H)
    r[0], r[1], r[9], r[14], r[15], r[20], r[23], r[26] = sn, item, code, "王小明", phone, date, note, stockin
    r[17] = "台北市\r\n信義路"
    return r


def test_marketplace_a(spark, tmp_dir):
    now = time.time()
    write_csv(f"{tmp_dir}/sales/2025/07/s1.csv", SALES_H,
              [sales_row("2025/07/01", "1001", "1", "狗糧\n大包", "100.50", "2.0"),
               sales_row("2025/07/01", "1002", "01", "貓砂", "50", "1")], bom=True, mtime=now - 100)
    write_csv(f"{tmp_dir}/sales/2025/07/s2.csv", SALES_H,
              [sales_row("2025/07/02", "1001", "1", "狗糧 新", "99.995", "3")], bom=True, mtime=now)
    write_csv(f"{tmp_dir}/sales/backup/old.csv", SALES_H, [sales_row("2020/01/01", "9", "1", "x", "1", "1")])
    write_csv(f"{tmp_dir}/ship/a.csv", SHIP_H,
              [ship_row("1001", "01", "912345678.0", "無", "4710001", "2025/7/3 10:00:00", "2025/7/6 上午 12:00:00"),
               ship_row("1003", "1", "", "請勿按鈴，無電梯", "", "2025/07/04", "")])
    products = spark.createDataFrame([("4710001", "Dog food", "BrandX")], "barcode string, product_name string, brand string")
    shops = spark.createDataFrame([("A", "shop-a")], "platform string, shop_name string")
    out = mp.marketplace_a(spark, f"{tmp_dir}/sales", f"{tmp_dir}/ship", products, shops)
    got = {r["order_line_uid"]: r for r in out.collect()}
    assert set(got) == {"1001_01", "1002_01", "1003_01"}                  # backup folder skipped, pad before key
    a = got["1001_01"]
    assert a["source"] == "both" and a["product_name_platform"] == "狗糧 新"  # newer file wins
    assert a["order_date"] == dt.date(2025, 7, 2) and a["quantity"] == 3 and str(a["unit_price"]) == "100.00"
    assert a["customer_phone"] == "0912345678" and a["note"] == ""
    assert a["expected_stockin_date"] == dt.date(2025, 7, 6)
    assert a["product_name"] == "Dog food" and a["brand"] == "BrandX" and a["shop_name"] == "shop-a"
    assert got["1003_01"]["source"] == "right_only" and got["1003_01"]["order_date"] == dt.date(2025, 7, 4)
    assert got["1003_01"]["note"] == "請勿按鈴，無電梯"
    assert got["1002_01"]["source"] == "left_only"


REG_B = cf.registry_from_rows([
    {"order": 1, "name": "order_sn", "local_name": "訂單編號", "type": "STRING", "required": "是"},
    {"order": 2, "name": "order_date", "local_name": "訂單成立日", "type": "STRING"},
    {"order": 3, "name": "product_manufacturer_code", "local_name": "商品原廠編號", "type": "STRING"},
    {"order": 4, "name": "quantity", "local_name": "數量", "type": "INTEGER"},
    {"order": 5, "name": "cost", "local_name": "成本", "type": "NUMERIC"},
    {"order": 6, "name": "platform", "local_name": "", "type": "STRING"},
])
HDR_B = ["訂單編號", "訂單成立日", "商品原廠編號", "數量", "成本"]


def test_marketplace_b(spark, tmp_dir):
    write_csv(f"{tmp_dir}/b2/A1102_2_1_013072_20250720163710.csv", HDR_B,
              [["25072112345678-001-001-001", "2025/7/1", "93766217126", "2.0", "12.345"],
               ["25072112345679-001-002-001", "", "4710001112223.0", "1", "5"],
               ["", "2025/7/1", "x", "1", "1"]], encoding="utf-8", bom=True)
    write_csv(f"{tmp_dir}/b3/A1102_3_第三方物流_013072_20250730_083714.csv", HDR_B,
              [["25072112345678-001-001-001", "2025/7/9", "nan", "9", "9"],
               ["25072212345670-001", "2025-07-02", "888800001", "1", "1"]], encoding="cp950")
    write_csv(f"{tmp_dir}/b3/A1102_3_013072_20250731_083714.csv", HDR_B,
              [["25072312345671", "2025/7/3", "", "1", "1"]], encoding="big5")
    products = spark.createDataFrame([("000093766217126", "Dog", 1), ("4710001112223", "Cat", 2), ("88880000123", "Bird", 3)],
                                     "barcode string, name string, position int")
    shops = spark.createDataFrame([("B", "s-old", 1), (" b ", "s-new", 2)], "platform string, shop_id string, position int")
    out = mp.marketplace_b(spark, {"A1102_2": f"{tmp_dir}/b2", "A1102_3": f"{tmp_dir}/b3"}, REG_B, products, shops)
    got = {r["order_sn"]: r for r in out.collect()}
    assert set(got) == {"25072112345678-001-001-001", "25072112345679-001-002-001", "25072212345670-001", "25072312345671"}
    a = got["25072112345678-001-001-001"]
    assert a["data_source"] == "A1102_2" and a["order_date"] == "2025-07-01" and a["quantity"] == 2
    assert str(a["cost"]) == "12.34" and a["product_name"] == "Dog" and a["match_stage"] == 2
    assert a["is_abnormal_order"] is False and a["shop_shop_id"] == "s-new"
    b = got["25072112345679-001-002-001"]
    assert b["is_abnormal_order"] is True and b["order_date"] == "2025-07-21" and b["product_name"] == "Cat"
    assert got["25072212345670-001"]["product_name"] == "Bird" and got["25072212345670-001"]["match_stage"] == 18
    assert got["25072312345671"]["order_sub_sequence"] == "001"
    assert out.columns[:6] == ["order_sn", "order_date", "product_manufacturer_code", "quantity", "cost", "platform"]


def test_marketplace_c(spark, tmp_dir):
    def tsv(path, lines):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write("\n".join(lines).encode("utf-16"))
    tsv(f"{tmp_dir}/c/o1.tsv", ["【※此匯出資料僅供參考】",
                                "訂單編號\t收件人電話\t商品名稱\t郵遞區號\t確認\t合併箱\t重量（公斤）",
                                "20250615001\t=\"0912345678\"\t狗糧 (DXAB12-A900XXX-7)\t10048\t已確認\t是\t1.5",
                                "20250615001\t=\"0912345678\"\t貓砂\t10048\t否\t否\t2"])
    tsv(f"{tmp_dir}/c/nobanner.tsv", ["訂單編號\t收件人電話", "X\t1"])
    tsv(f"{tmp_dir}/r/ret.tsv", ["訂單編號\t退貨申請日\t審核通過日\t商品名稱", "20250615001\t2025/6/20\t2025/6/21\t狗糧"])
    reg = spark.createDataFrame([("order_sn", "訂單編號", 1), ("receiver_phone", "收件人電話", 2), ("product_name", "商品名稱", 3),
                                 ("receiver_zip", "郵遞區號", 4), ("confirm", "確認", 5), ("is_merge_box", "合併箱", 6),
                                 ("weight", "重量", 7), ("item_seq", "明細序號", 8)],
                                "name string, local_name string, reg_order int")
    out = mp.marketplace_c(spark, f"{tmp_dir}/c", f"{tmp_dir}/r", reg)
    got = {r["order_id"]: r for r in out.collect()}
    assert set(got) == {"20250615001-01", "20250615001-02"}
    a = got["20250615001-01"]
    assert a["source_file"] == "ret.tsv"                       # the return report is the newer generation
    b = got["20250615001-02"]
    assert b["receiver_phone"] == "0912345678" and b["receiver_zip"] == "100" and b["confirm"] is False
    assert b["order_date"] == dt.date(2025, 6, 15) and b["order_weekday"] == 1
    o = spark.createDataFrame([], "x string")
    assert o.count() == 0


REG_D = cf.registry_from_rows([
    {"order": 1, "name": "order_sn", "local_name": "訂單編號", "type": "STRING"},
    {"order": 2, "name": "order_date", "local_name": "轉單日", "type": "STRING"},
    {"order": 3, "name": "recipient_name", "local_name": "收件人姓名", "type": "STRING"},
    {"order": 4, "name": "product_id", "local_name": "商品編號", "type": "STRING"},
    {"order": 5, "name": "product_name", "local_name": "商品名稱", "type": "STRING"},
])


def test_marketplace_d(spark, tmp_dir):
    h = ["訂單編號", "轉單日", "收件人姓名", "收件人地址", "商品編號", "商品名稱"]
    write_csv(f"{tmp_dir}/d/x1.csv", h, [
        ["RM2506210008426", "2025/06/21", "Amy", "a", "P1", "狗"], ["RM2506210008427", "2025/06/21", "Amy", "a", "P2", "貓砂大包"],
        ["RM2506210008428", "2025/06/21", "Amy", "a", "P1", "狗"], ["RM2506210008430", "2025/06/21", "Amy", "a", "P1", "狗"],
        ["RM2506210008430", "2025/06/21", "Amy", "a", "P1", "狗"], ["RMABC", "2025/06/21", "Amy", "a", "P9", "x"],
        ["RM2506220000001", "", "Bob", "b", "P1", "狗"]])
    shops = spark.createDataFrame([("shop-d", "S9", "D")], "shop_name string, shop_id string, platform string")
    products = spark.createDataFrame([("P1", "狗狗乾糧"), ("P2", "貓")], "product_id string, product_name string")
    out = mp.marketplace_d(spark, f"{tmp_dir}/d", REG_D, shops, "shop-d", products)
    rows = out.collect()
    # an id that is no RM number counts as 0; only blank ids go last
    assert [r["order_sn"] for r in rows] == ["RMABC", "RM2506210008426", "RM2506210008427", "RM2506210008428",
                                             "RM2506210008430", "RM2506220000001"]
    got = {r["order_sn"]: r for r in rows}
    assert [got[k]["line_no"] for k in ("RM2506210008426", "RM2506210008427", "RM2506210008428", "RM2506210008430")] == \
        ["1", "2", "3", "1"]
    assert got["RM2506220000001"]["order_date"] == "2025/06/22" and got["RMABC"]["is_invalid"] is False
    assert got["RM2506210008426"]["product_name"] == "狗狗乾糧" and got["RM2506210008427"]["product_name"] == "貓砂大包"
    assert {r["shop_shop_id"] for r in rows} == {"S9"} and rows[0]["report_type"] == "sps_orders"


def test_marketplace_e(spark, tmp_dir):
    h = ["訂單編號", "訂單成立時間", "商品名稱", "主商品貨號\n", "商品選項貨號", "數量", "買家帳號"]
    write_csv(f"{tmp_dir}/e/shop_acct_Order.all.csv", h, [
        ["250701ABC", "2025-07-01 10:00", "狗糧", "111.0", "A", "1", "u1"],
        ["250702XYZ", "", "貓砂", "222", "", "2", "u2"],
        ["", "2025-07-01 10:00", "x", "1", "1", "1", "u3"]], bom=True)
    reg = spark.createDataFrame([("order_sn", "訂單編號", 1), ("order_creation_timestamp", "訂單成立時間", 2),
                                 ("product_name", "商品名稱", 3), ("product_sku_main", "主商品貨號", 4),
                                 ("product_sku_variation", "商品選項貨號", 5), ("quantity", "數量", 6),
                                 ("buyer_username", "買家帳號", 7)], "name string, local_name string, reg_order int")
    old = spark.createDataFrame([("250701ABC_111_A", "250701ABC", "2025-07-01", "舊", "1")],
                                "order_line_uid string, order_sn string, order_date string, product_name string, quantity string")
    out = mp.marketplace_e(spark, f"{tmp_dir}/e", reg, "2025-07-05 00:00:00", old=old)
    got = {r["order_line_uid"]: r for r in out.collect()}
    assert set(got) == {"250701ABC_111_A", "250702XYZ_222_"}
    assert got["250701ABC_111_A"]["product_name"] == "狗糧" and got["250701ABC_111_A"]["order_date"] == "2025-07-01"
    assert got["250702XYZ_222_"]["order_date"] == "2025-07-02" and got["250702XYZ_222_"]["item_seq"] == 1
