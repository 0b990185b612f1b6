"""Per-marketplace flows: raw report folders -> one typed order-line table.

Each flow only wires library operators; every step is lazy except the small
bounded actions the operators document (header peeks, broadcast size checks).
Report files are plain text (CSV / TSV); provenance comes from file metadata.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import functions as fn
from orderlake.operators import conform as cf
from orderlake.operators import dedupe, enrich, headers, ordering, quality, reconcile
from orderlake.operators import sequence as sq
from orderlake.operators import upsert as up
from orderlake.operators._common import sized_broadcast
from orderlake.sources import files

# ------------------------------------------------------------------ fixed values
# Marketplace A sales-report headers -> canonical names (unmapped headers dropped).
SALES_HEADERS_A = {
    "訂單日期": "order_date", "訂單編號": "order_sn", "項次": "item_no", "配送狀態": "shipping_status",
    "訂單狀態": "order_status", "商品屬性": "product_attribute", "銷售編號": "product_sale_id",
    "子商品銷售編號": "sub_sale_id", "子商品商品編號": "sub_product_id", "配送方式": "shipping_method",
    "商品名稱": "product_name_platform", "顏色": "color", "款式": "style", "售價": "unit_price",
    "成本": "cost_to_platform", "數量": "quantity", "通路": "channel", "配送確認日": "shipping_confirm_date",
}
# Marketplace A shipping-report headers -> canonical names (unmapped headers kept).
SHIPPING_HEADERS_A = {
    "訂單號碼": "order_sn", "訂單項次": "item_no", "併單序號": "merge_no", "送貨單號": "shipping_sn",
    "銷售編號": "product_sale_id", "商品編號": "product_id", "商品名稱": "product_name_platform", "顏色": "color",
    "款式": "style", "廠商商品號碼": "seller_product_sn", "訂單類別": "order_type", "數量": "quantity",
    "售價": "unit_price", "成本": "cost_to_platform", "客戶名稱": "customer_name", "客戶電話": "customer_phone",
    "室內電話": "customer_tel", "配送地址": "shipping_address", "貨運公司": "shipping_carrier",
    "配送單號": "shipping_code", "出貨指示日": "order_date", "要求配送日": "shipping_request_date",
    "要求配送時間": "shipping_expected_time", "備註": "note", "贈品": "gift_info",
    "廠商配送訊息": "vendor_shipping_note", "預計入庫日": "expected_stockin_date",
    "預計配送日": "expected_delivery_date", "通路別": "channel_type", "訂單類別代號": "order_type_code",
    "公司別": "company",
}
# Marketplace D report types: file-name keywords and header indicators.
REPORT_TYPES_D = {"retgood": ["退貨單號", "退貨單序號"], "delivery": ["超商類型"],
                  "sps_orders": ["收件人姓名", "收件人地址"], "orders": ["訂單編號", "商品名稱"]}
NAME_KEYWORDS_D = {"retgood": "retgood", "delivery": "delivery", "sps": "sps_orders", "orders": "orders"}
# Marketplace C: banner of the order export and the return-report header keywords.
BANNER_C = "【※此匯出資料"
RETURN_HEADERS_C = ["退貨申請", "審核通過"]
# Marketplace B: shipping sources by priority (unknown sources rank 0).
SOURCE_RANKS_B = {"A1102_2": 2, "A1102_3": 1}


def _string_cols(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and not c.startswith("source_")]


def _clean_all(df: DataFrame, cleaner) -> DataFrame:
    cols = set(_string_cols(df))
    return df.select(*[cleaner(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def _read_text_reports(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    rows, report = files.read_reports(spark, path, glob=glob)
    for r in report.filter("NOT readable OR bad_records > 0").collect():       # one row per file
        logging.getLogger("orderlake").warning(
            "%s: %s", r["path"], f"{r['bad_records']} records have more cells than the header" if r["readable"]
            else "no encoding reads it; the file is left out")
    return rows.drop(files.CORRUPT)


# ------------------------------------------------------------------ marketplace A

def marketplace_a(spark: SparkSession, sales_path: str, shipping_path: str, products: DataFrame | None = None,
                  shops: DataFrame | None = None, platform: str = "A") -> DataFrame:
    """Sales + shipping reports -> reconciled, typed, enriched order lines.

    Keys: ``order_line_uid = order_sn _ zero-padded item_no`` on both reports
    (padding before the key, Q1).  Each report keeps the newest file's row per
    line (W1, seq = file mtime, file name); the two are full-outer reconciled
    (J1, one row per key on each side) with the sales date preferred (J3).
    """
    sales = _clean_all(_read_text_reports(spark, sales_path), fn.strip_newlines)
    sales = cf.rename(sales, {**SALES_HEADERS_A, **{c: c for c in sales.columns if c.startswith("source_")}},
                      unmapped="drop")
    ship = _clean_all(_read_text_reports(spark, shipping_path), fn.normalize_ws)
    ship = cf.rename(ship, SHIPPING_HEADERS_A, unmapped="keep")
    out = []
    for df in (sales, ship):
        df = quality.require_key(df, "order_sn")
        df = df.withColumn("item_no", fn.zero_pad(fn.strip_float_suffix("item_no"), 2))
        df = df.withColumn("order_line_uid", fn.line_uid("order_sn", "item_no"))
        out.append(dedupe.keep_last(df, "order_line_uid", ["source_mtime", "source_file", "source_line"]))
    sales, ship = out
    ship = (ship.withColumn("customer_phone", fn.format_phone("customer_phone", "nine"))
            .withColumn("note", fn.truncate_at_word("note", "無", anchored=True)))
    keep = [c for c in ship.columns if c in ("order_line_uid", "order_date", "customer_name", "customer_phone",
                                               "shipping_address", "shipping_carrier", "shipping_code", "note",
                                               "seller_product_sn", "product_id", "expected_stockin_date")]
    rec = reconcile.reconcile(sales.drop("source_file", "source_path", "source_mtime", "source_encoding", "source_line"),
                              ship.select(*keep), "order_line_uid", suffix="_shipping", unique="left",
                              coalesce_cols={"order_date": ("order_date", "order_date")})
    dt = fn.split_datetime("order_date")
    rec = (rec.withColumn("order_time", dt.time).withColumn("order_date", dt.date)
           .withColumn("expected_stockin_date", fn.parse_ampm_local("expected_stockin_date"))
           .withColumn("quantity", fn.to_int_zero("quantity"))
           .withColumn("unit_price", fn.money2("unit_price", 0))
           .withColumn("cost_to_platform", fn.money2("cost_to_platform", 0)))
    rec = cf.stamp(rec, always={"platform": platform})
    if shops is not None:
        rec = enrich.overwrite(rec, shops, on="platform", cols=[c for c in shops.columns if c != "platform"],
                               dim_key="platform")
    if products is not None:
        rec = enrich.overwrite(rec.withColumn("__code", fn.clean_code("seller_product_sn")), products,
                               on="__code", cols=[c for c in products.columns if c != "barcode"],
                               dim_key="barcode").drop("__code")
    return rec


# ------------------------------------------------------------------ marketplace B

def marketplace_b(spark: SparkSession, paths_by_source: Mapping[str, str], registry: Sequence[cf.Field],
                  products: DataFrame | None = None, shops: DataFrame | None = None, platform: str = "B",
                  key_prefix: str = "b_") -> DataFrame:
    """Accounting / shipping exports in several encodings -> one row per order.

    Sources are unioned by priority (J12) and remaining duplicates resolved by
    source rank (W3); ids are split (T14) and flagged (T15); dates re-dashed
    (D2) or taken from the id (D6); products resolved by the padded/prefix
    cascade (J8/J9) and shops by case-folded platform (J10).
    """
    parts = []
    for label, path in paths_by_source.items():
        df = cf.registry_rename(_read_text_reports(spark, path), registry)
        parts.append(quality.require_key(df, "order_sn").withColumn("data_source", F.lit(label)))
    merged = up.priority_union(parts, "order_sn")
    merged = dedupe.keep_priority(merged, "order_sn", "data_source", SOURCE_RANKS_B, ["source_mtime", "source_file", "source_line"])
    ids = fn.split_composite_id("order_sn")
    merged = (merged.withColumn("__id", ids)
              .withColumn("order_sn_main", F.col("__id.order_main")).withColumn("order_line_number", F.col("__id.order_line"))
              .withColumn("order_sub_sequence", F.col("__id.order_sub"))
              .withColumn("order_detail_sequence", F.col("__id.order_detail")).drop("__id")
              .withColumn("is_abnormal_order", fn.is_abnormal_subseq("order_sub_sequence", "order_detail_sequence"))
              .withColumn("key_for_merge", fn.line_uid("order_sn", prefix=key_prefix)))
    if "order_date" in merged.columns:
        merged = merged.withColumn("order_date", F.when(fn.dash_date("order_date") != "", fn.dash_date("order_date"))
                                   .otherwise(fn.date_from_id_yymmdd("order_sn")))
    else:
        merged = merged.withColumn("order_date", fn.date_from_id_yymmdd("order_sn"))
    merged = cf.stamp(merged, always={"platform": platform})
    if products is not None and "product_manufacturer_code" in merged.columns:
        merged = enrich.lookup_cascade(merged, products, "product_manufacturer_code", "barcode", "position",
                                       out="matched_barcode", stage="match_stage")
        attrs = [c for c in products.columns if c not in ("barcode", "position")]
        merged = enrich.fill(merged, products, on="matched_barcode", cols=attrs, dim_key="barcode",
                             position="position", prefix="product_")
    if shops is not None:
        merged = enrich.casefold_join(merged, shops, "platform", "platform",
                                      [c for c in shops.columns if c not in ("platform", "position")], "position")
    return cf.conform(merged, registry, extras="last")


# ------------------------------------------------------------------ marketplace C

def _header_table(rows: DataFrame) -> DataFrame:
    return (rows.select("source_path", "header").distinct()
            .select(F.col("source_path").alias("file"), F.posexplode("header").alias("position", "header")))


def _project_matched(rows: DataFrame, matched: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long rows + the matched position of each canonical name per file -> one
    column per canonical name: each cell is picked by its file's position (one
    small row per file)."""
    index = matched.groupBy(F.col("file").alias("source_path")).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "position"))).alias("__at"))    # at most one entry a name
    j = rows.join(sized_broadcast(index), "source_path")
    return j.select("source_path", "source_file", "line_no", *[
        F.when(F.col("__at")[n].isNotNull(), F.get("values", F.col("__at")[n])).alias(n) for n in names])


def marketplace_c(spark: SparkSession, orders_path: str, returns_path: str, registry: DataFrame,
                  platform: str = "C") -> DataFrame:
    """UTF-16 TSV order exports (banner line first) and return reports ->
    typed order lines.  Headers are matched to the registry by normalised /
    fuzzy match (P3), and only matched columns are kept."""
    names = [r["name"] for r in registry.select("name").collect()]       # registry: small config
    o_rows = files.read_banner_tsv(spark, orders_path, banner=BANNER_C)
    o = _project_matched(o_rows, headers.match_fuzzy(_header_table(o_rows), registry), names)
    r_rows = files.read_banner_tsv(spark, returns_path, header_line=1, require_headers=RETURN_HEADERS_C)
    r = _project_matched(r_rows, headers.match_fuzzy(_header_table(r_rows), registry), names)
    out = []
    for df in (o, r):
        df = _clean_all(df, fn.unquote_formula)
        df = quality.require_key(df, "order_sn")
        df = sq.number_within(df, "order_sn", ["source_path", "line_no"], out="__seq", pad=2)
        df = df.withColumn("item_seq", F.coalesce(F.when(F.col("item_seq") != "", fn.zero_pad("item_seq", 2)),
                                                  F.col("__seq_text"))).drop("__seq", "__seq_text")
        out.append(df.withColumn("order_id", fn.line_uid("order_sn", "item_seq", sep="-")))
    o, r = out
    allrows = up.upsert(o, r, "order_id", order=["source_path", "line_no"])
    ref = fn.product_ref_from_name("product_name")
    return (allrows.withColumn("order_date", fn.date_from_id_yyyymmdd("order_sn"))
            .withColumn("order_weekday", fn.weekday_sun1("order_date"))
            .withColumn("order_week", fn.iso_week("order_date"))
            .withColumn("product_id", ref.ref_id).withColumn("sku_option", ref.ref_option)
            .withColumn("confirm", fn.bool_equals_label("confirm", "已確認"))
            .withColumn("is_merge_box", fn.bool_equals_label("is_merge_box", "是"))
            .withColumn("receiver_zip", fn.zip_prefix("receiver_zip"))
            .withColumn("platform", F.lit(platform)))


# ------------------------------------------------------------------ marketplace D

def classify_files(spark: SparkSession, path: str) -> DataFrame:
    """S8 for marketplace D: (path, file, encoding, report_type) by file name,
    then by the header line's indicators."""
    h = files.header_lines(spark, path).withColumnRenamed("header", "header_list")
    return headers.classify_reports(h, REPORT_TYPES_D, NAME_KEYWORDS_D, min_hits=1, first_n=8).drop("header_list")


def marketplace_d(spark: SparkSession, path: str, registry: Sequence[cf.Field], shops: DataFrame,
                  shop_name: str, products: DataFrame | None = None, platform: str = "D") -> DataFrame:
    """Order reports of several types -> de-duplicated, run-numbered lines.

    Run numbers are computed per source file before the union (Q14), the
    composite-key duplicates keep the first row (W2), ids sort by their
    number with unparseable ids last (O2/F4), the one shop is stamped (J11) and
    product names take the longer master name (J6)."""
    types: dict[str, dict[str, list[str]]] = {}
    for r in classify_files(spark, path).orderBy("path").collect():        # one row per file, ≤ 5 types
        types.setdefault(r["report_type"], {}).setdefault(r["encoding"], []).append(files.splits.escaped(r["path"]))
    parts = []
    for t, paths in types.items():
        df = cf.registry_rename(files.read_orders(spark, paths).drop(files.CORRUPT), registry)
        parts.append(df.withColumn("report_type", F.lit(t)))
    allr = reconcile.union_reports(*parts, source_col=None)
    if "order_date" not in allr.columns:
        allr = allr.withColumn("order_date", F.lit(None).cast("string"))
    allr = allr.withColumn("order_date", F.when(F.trim("order_date") != "", F.col("order_date"))
                           .otherwise(fn.date_from_id_prefixed("order_sn")))
    allr = sq.consecutive_runs(allr, "order_date", "recipient_name", "order_sn", prefix="RM",
                               scope=["source_file"], out="line_no")
    keys = [k for k in ("order_sn", "product_id", "recipient_name", "product_name") if k in allr.columns]
    allr = dedupe.keep_first(allr, keys, ["source_mtime", "source_file", "source_line"])
    allr = enrich.attach_single(allr, shops, F.col("shop_name") == shop_name,
                                [c for c in shops.columns if c != "shop_name"], prefix="shop_")
    if products is not None:
        allr = enrich.fill(allr, products.select("product_id", F.col("product_name").alias("master_name")),
                           on="product_id", cols=["master_name"])
        allr = allr.withColumn("product_name", enrich.prefer_longer("product_name", "master_name")).drop("master_name")
    allr = cf.stamp(allr, always={"platform": platform})
    invalid = ~ordering.filled("order_sn")
    return ordering.sort_prefixed_id(allr.withColumn("is_invalid", invalid), "order_sn", "RM", F.col("is_invalid"))


# ------------------------------------------------------------------ marketplace E

def marketplace_e(spark: SparkSession, path: str, registry: DataFrame, run_ts: str,
                  old: DataFrame | None = None, default_import_ts: str = "2024-01-01 00:00:00") -> DataFrame:
    """CSV exports with messy headers -> upserted master table.

    Headers are matched by containment (P4); blank orders dropped (F1); the
    date comes from the creation timestamp (D12) or the id (D6); SKUs lose
    ``.0`` (T4); the key is sn_sku_variation (T13); the newest import wins
    (K6 by timestamp, W4) and item sequences are renumbered (W6)."""
    raw = _read_text_reports(spark, path)
    hdr = spark.createDataFrame([("all", i, c) for i, c in enumerate(raw.columns)],
                                "file string, position int, header string")
    m = {r["header"]: r["name"] for r in headers.match_contains(hdr, registry).collect()}   # one row per header
    df = cf.rename(raw, {**m, **{c: c for c in raw.columns if c.startswith("source_")}}, unmapped="drop")
    df = quality.require_key(df, "order_sn")
    ts_date = fn.date_from_timestamp("order_creation_timestamp") if "order_creation_timestamp" in df.columns \
        else F.lit("")
    df = df.withColumn("order_date", F.when(ts_date != "", ts_date).otherwise(fn.date_from_id_yymmdd("order_sn")))
    for c in ("product_sku_main", "product_sku_variation"):
        if c in df.columns:
            df = df.withColumn(c, fn.strip_float_suffix(c))
    df = df.withColumn("order_line_uid", fn.line_uid("order_sn", "product_sku_main", "product_sku_variation"))
    df = df.withColumn("data_import_timestamp", F.to_timestamp(F.lit(run_ts)))
    source = ["source_mtime", "source_file", "source_line"]
    df = dedupe.keep_last(df, "order_line_uid", ["data_import_timestamp", *source]).drop(
        *source, "source_path", "source_encoding")
    if old is not None:
        if "data_import_timestamp" not in old.columns:
            old = old.withColumn("data_import_timestamp", F.to_timestamp(F.lit(default_import_ts)))
        df = up.upsert(old, df, "order_line_uid", ts="data_import_timestamp", require="order_date")
    return sq.number_within(df, ["order_date", "order_sn"], ["order_line_uid"], out="item_seq")
