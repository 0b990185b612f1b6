"""Registered checks: each runs one operator family over the driver tables
(whole tables, whole texts) and has an independent SQL statement computing the
same result, so results can be compared engine against engine.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Column names are aliased identically on both sides.  Money is summed as
DECIMAL, counts and sequence numbers are BIGINT.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake import functions as fn
from orderlake.operators import calendar as cal
from orderlake.operators import conform as cf
from orderlake.operators import dedupe, enrich, headers, quality, reconcile
from orderlake.operators import sequence as sq
from orderlake.operators import upsert as up
from orderlake.session import scratch_path
from orderlake.sources import files, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def deco(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql.strip()
        return f
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# SQL fragments shared by several oracles ------------------------------------

LINE_TIES_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus"])
LINE_TIES_ASC = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus"])
LINES_LAST_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC NULLS LAST, {LINE_TIES_DESC}) AS rn FROM lineitem) WHERE rn = 1"""


# ---------------------------------------------------------------- flagship

def _lines_keep_last(spark, d):
    return dedupe.keep_last(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@check("order_reconcile", f"""
WITH l AS ({LINES_LAST_SQL}),
r AS (
  SELECT coalesce(o.o_orderkey, l.l_orderkey) AS order_key, l.l_linenumber AS line_no,
         o.o_orderstatus AS order_status, CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(l.l_shipdate AS DATE) AS ship_date, l.l_partkey AS part_key,
         l.l_quantity AS quantity, l.l_extendedprice AS extended_price,
         CASE WHEN o.o_orderkey IS NOT NULL AND l.l_orderkey IS NOT NULL THEN 'both'
              WHEN o.o_orderkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS source
  FROM orders o FULL OUTER JOIN l ON o.o_orderkey = l.l_orderkey)
SELECT r.order_key, r.line_no,
       concat_ws('_', coalesce(CAST(r.order_key AS VARCHAR), ''),
                 coalesce(CASE WHEN length(CAST(r.line_no AS VARCHAR)) < 2
                               THEN lpad(CAST(r.line_no AS VARCHAR), 2, '0')
                               ELSE CAST(r.line_no AS VARCHAR) END, '')) AS line_uid,
       r.order_status, r.order_date, r.ship_date, coalesce(r.order_date, r.ship_date) AS report_date,
       r.part_key, r.quantity, r.extended_price,
       coalesce(p.p_name, CASE WHEN r.part_key IS NULL THEN NULL ELSE 'part-' || CAST(r.part_key AS VARCHAR) END) AS product_name,
       p.p_brand AS brand, r.source
FROM r LEFT JOIN part p ON r.part_key = p.p_partkey
""")
def order_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """W1 + J1 + J2-style provenance + J3 + J4: one trusted order-line table
    from the order report and the (de-duplicated) line report, enriched from
    the product master."""
    lines = _lines_keep_last(spark, d).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
        F.to_date("l_shipdate").alias("ship_date"), F.col("l_partkey").alias("part_key"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extended_price"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("order_status"),
        F.to_date("o_orderdate").alias("order_date"))
    raw_keys = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    rec = reconcile.reconcile(orders, lines, "order_key", unique="left", null_safe=False, many_keys=raw_keys,
                              coalesce_cols={"report_date": ("order_date", "ship_date")})
    rec = rec.withColumn("product_name", F.when(F.col("part_key").isNotNull(),
                                                F.concat(F.lit("part-"), F.col("part_key").cast("string"))))
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("product_name"),
                                          F.col("p_brand").alias("brand"))
    rec = enrich.overwrite(rec, part, on="part_key", cols=["product_name", "brand"], dim_key="p_partkey")
    uid = fn.line_uid("order_key", fn.zero_pad(F.col("line_no").cast("string"), 2))
    return rec.select("order_key", "line_no", uid.alias("line_uid"), "order_status", "order_date",
                      "ship_date", "report_date", "part_key", "quantity", "extended_price",
                      "product_name", "brand", "source")


@check("key_coverage", """
WITH lk AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
     rk AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CASE WHEN lk.n IS NOT NULL AND rk.n IS NOT NULL THEN 'both'
            WHEN lk.n IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS coverage,
       count(*) AS n_keys, CAST(coalesce(sum(lk.n), 0) AS BIGINT) AS left_rows,
       CAST(coalesce(sum(rk.n), 0) AS BIGINT) AS right_rows
FROM lk FULL OUTER JOIN rk ON lk.k = rk.k GROUP BY 1
""")
def key_coverage(spark, d):
    """Common / orders-only / lineitem-only keys and their rows."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return reconcile.key_coverage(o, li, "k")


@check("dedupe_keep_last", LINES_LAST_SQL)
def dedupe_keep_last(spark, d):
    """W1 on (l_orderkey, l_linenumber), latest ship date, then all columns."""
    return _lines_keep_last(spark, d)


@check("dedupe_keep_first", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate ASC NULLS FIRST, {LINE_TIES_ASC}) AS rn FROM lineitem) WHERE rn = 1
""")
def dedupe_keep_first(spark, d):
    """Earliest ship date per line key, then all columns ascending."""
    return dedupe.keep_first(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# Fixed test parameters: source ranks for the priority dedupe.
SOURCE_RANKS = {"src0": 3, "src1": 2, "src2": 1}


@check("dedupe_source_priority", """
WITH t AS (
  SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5,
         CASE source WHEN 'src0' THEN 3 WHEN 'src1' THEN 2 WHEN 'src2' THEN 1 ELSE 0 END AS source_rank
  FROM documents)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text_md5 ORDER BY source_rank DESC, doc_id ASC) AS rn FROM t)
WHERE rn = 1
""")
def dedupe_source_priority(spark, d):
    """One document per exact text (md5 of the whole text); the highest
    ranked source wins, then the smallest doc_id."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars",
                                               F.md5("text").alias("text_md5"))
    return dedupe.keep_priority(docs, "text_md5", "source", SOURCE_RANKS, "doc_id", keep_rank=True)


EVENTS_LATEST_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
         ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, value DESC NULLS LAST,
                  props DESC NULLS LAST) AS rn FROM events) WHERE rn = 1
"""


@check("dedupe_latest", EVENTS_LATEST_SQL)
def dedupe_latest(spark, d):
    """Latest event per (user, event type), ties by event id."""
    return dedupe.keep_latest(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id")


# ---------------------------------------------------------------- upsert

def _cutoffs(orders: DataFrame) -> tuple:
    """70 % / 60 % points of the order-date span (one single-row aggregate)."""
    r = orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")) \
        .select(F.date_add("lo", F.floor(F.datediff("hi", "lo") * 0.7).cast("int")).alias("c70"),
                F.date_add("lo", F.floor(F.datediff("hi", "lo") * 0.6).cast("int")).alias("c60")).first()
    return r["c70"], r["c60"]


@check("upsert_orders", """
WITH d AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders),
b AS (SELECT min(order_date) AS lo, max(order_date) AS hi FROM d),
c AS (SELECT lo + CAST(floor(date_diff('day', lo, hi) * 0.7) AS INTEGER) AS c70,
             lo + CAST(floor(date_diff('day', lo, hi) * 0.6) AS INTEGER) AS c60 FROM b),
u AS (SELECT d.*, 0 AS gen FROM d, c WHERE order_date < c70
      UNION ALL
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, order_date, 1 FROM d, c WHERE order_date >= c60),
k AS (SELECT * EXCLUDE (rn, gen) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY gen DESC, o_custkey DESC NULLS LAST,
               o_orderstatus DESC NULLS LAST, o_totalprice DESC NULLS LAST, order_date DESC NULLS LAST) AS rn FROM u)
      WHERE rn = 1)
SELECT *, CAST(row_number() OVER (PARTITION BY order_date ORDER BY o_orderkey) AS BIGINT) AS seq FROM k
""")
def upsert_orders(spark, d):
    """K6 + F2 + W6: old snapshot (first 70 % of days) upserted with a re-priced
    newer snapshot (last 40 %); then re-sequenced per order date."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                         F.to_date("o_orderdate").alias("order_date"))
    c70, c60 = _cutoffs(table(spark, d, "orders"))
    old = o.filter(F.col("order_date") < F.lit(c70))
    new = o.filter(F.col("order_date") >= F.lit(c60)).withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    merged = up.upsert(old, new, "o_orderkey", require="order_date")
    return sq.number_within(merged, "order_date", ["o_orderkey"], out="seq")


@check("priority_union", """
SELECT o_orderkey, o_custkey, o_orderstatus, 'F' AS source FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, 'P' AS source FROM orders p
WHERE o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_custkey = p.o_custkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, 'other' AS source FROM orders p
WHERE o_orderstatus NOT IN ('F', 'P') AND NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus IN ('F', 'P') AND f.o_custkey = p.o_custkey)
""")
def priority_union(spark, d):
    """customers' F orders, then P orders of customers without any F,
    then the other orders of customers without either."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return up.priority_union([o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'"),
                              o.filter("o_orderstatus NOT IN ('F', 'P')")],
                             "o_custkey", source_col="source", labels=["F", "P", "other"])


# ---------------------------------------------------------------- sequences

LINE_ALL_ASC = ", ".join(["l_linenumber"] + [f"{c} ASC NULLS FIRST" for c in [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate"]])


@check("line_sequence", f"""
WITH s AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ALL_ASC}) AS BIGINT) AS seq FROM lineitem)
SELECT *, CASE WHEN length(CAST(seq AS VARCHAR)) < 2 THEN lpad(CAST(seq AS VARCHAR), 2, '0') ELSE CAST(seq AS VARCHAR) END AS seq_text,
       CAST(l_orderkey AS VARCHAR) || '-' || CASE WHEN length(CAST(seq AS VARCHAR)) < 2 THEN lpad(CAST(seq AS VARCHAR), 2, '0') ELSE CAST(seq AS VARCHAR) END AS line_uid
FROM s
""")
def line_sequence(spark, d):
    """W5 + T5 + T13: item sequence inside each order, zero-padded, and the
    ``order-seq`` line key.  Skew-safe segmented scan (no per-group task)."""
    li = table(spark, d, "lineitem")
    s = sq.number_within(li, "l_orderkey", ["l_linenumber"], out="seq", pad=2)
    return s.withColumn("line_uid", fn.line_uid("l_orderkey", "seq_text", sep="-"))


@check("consecutive_runs", """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ship_date, l_linestatus AS recipient,
                           CAST(l_orderkey AS VARCHAR) AS order_sn FROM lineitem),
s AS (SELECT *, lag(ship_date) OVER w AS pd, lag(recipient) OVER w AS pr, lag(order_sn) OVER w AS ps,
             row_number() OVER w AS pos
      FROM d WINDOW w AS (ORDER BY ship_date, recipient, order_sn)),
f AS (SELECT *, CASE WHEN pos = 1 THEN 1
                     WHEN pd IS DISTINCT FROM ship_date OR pr IS DISTINCT FROM recipient THEN 1
                     WHEN coalesce(trim(ps), '') <> '' AND coalesce(trim(order_sn), '') <> ''
                          AND (TRY_CAST(replace(order_sn, 'RM', '') AS BIGINT) IS NULL
                               OR TRY_CAST(replace(ps, 'RM', '') AS BIGINT) IS NULL
                               OR TRY_CAST(replace(order_sn, 'RM', '') AS BIGINT) <> TRY_CAST(replace(ps, 'RM', '') AS BIGINT) + 1)
                     THEN 1 ELSE 0 END AS brk FROM s),
g AS (SELECT *, sum(brk) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM f)
SELECT ship_date, recipient, order_sn, CAST(row_number() OVER (PARTITION BY grp ORDER BY pos) AS VARCHAR) AS line_no FROM g
""")
def consecutive_runs(spark, d):
    """Runs of consecutive order ids per (ship date, line status); the
    number inside the run, as text."""
    base = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("ship_date"), F.col("l_linestatus").alias("recipient"),
        F.col("l_orderkey").cast("string").alias("order_sn")).distinct()
    return sq.consecutive_runs(base, "ship_date", "recipient", "order_sn", prefix="RM", out="line_no")


# ---------------------------------------------------------------- calendar

ORDER_DAYS_SQL = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL"
MISSING_DAYS_SQL = f"""
SELECT CAST(g.d AS DATE) AS day
FROM (SELECT min(day) AS lo, max(day) AS hi FROM ({ORDER_DAYS_SQL})) b,
     generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
WHERE CAST(g.d AS DATE) NOT IN ({ORDER_DAYS_SQL})
"""


@check("missing_days", MISSING_DAYS_SQL)
def missing_days(spark, d):
    """Calendar days between the first and last order date with no order."""
    return cal.missing_days(table(spark, d, "orders"), "o_orderdate")


@check("missing_ranges", f"""
WITH m AS ({MISSING_DAYS_SQL}),
i AS (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS grp FROM m)
SELECT min(day) AS start_day, max(day) AS end_day, CAST(count(*) AS BIGINT) AS n_days,
       CASE WHEN min(day) = max(day) THEN CAST(min(day) AS VARCHAR)
            ELSE CAST(min(day) AS VARCHAR) || '~' || CAST(max(day) AS VARCHAR) END AS label
FROM i GROUP BY grp
""")
def missing_ranges(spark, d):
    """Missing days collapsed to ``start~end`` ranges."""
    return cal.missing_ranges(cal.missing_days(table(spark, d, "orders"), "o_orderdate"))


@check("completeness", """
WITH days AS (SELECT DISTINCT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL),
span AS (SELECT p, min(day) AS lo, max(day) AS hi FROM days GROUP BY p),
calendar AS (SELECT p, CAST(g.d AS DATE) AS day FROM span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)),
j AS (SELECT c.p, c.day, d.day AS have FROM calendar c LEFT JOIN days d ON c.p = d.p AND c.day = d.day),
a AS (SELECT p AS o_orderpriority, min(day) AS first_day, max(day) AS last_day, count(*) AS total_days,
             count(*) FILTER (WHERE have IS NULL) AS missing_days FROM j GROUP BY p)
SELECT *, CAST(round(CAST((total_days - missing_days) * 100.0 / total_days AS DECIMAL(20,6)), 1) AS DECIMAL(5,1)) AS completeness_pct FROM a
""")
def completeness(spark, d):
    """Per order priority, days covered, missing days and completeness %."""
    return cal.completeness(table(spark, d, "orders"), "o_orderdate", by="o_orderpriority")


@check("missing_counterpart_by_day", """
SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders
FROM orders o
WHERE o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL
  AND NOT coalesce(regexp_matches(o_orderstatus, '^F$'), false)
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
GROUP BY 1
""")
def missing_counterpart_by_day(spark, d):
    """F3 + A10: per day, orders with no line rows (status F excluded)."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    miss = cal.missing_counterpart(o, li, "o_orderkey", exclude_status="^F$", status="o_orderstatus",
                                   date="o_orderdate")
    return cal.missing_by_day(miss, "o_orderdate", "o_orderkey")


# ---------------------------------------------------------------- duplicates

@check("duplicate_stats", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_keys,
       CAST(coalesce(max(n), 0) AS BIGINT) AS max_multiplicity
FROM k
""")
def duplicate_stats(spark, d):
    """A1 on the line key."""
    return dedupe.duplicate_stats(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("duplicate_top", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1
ORDER BY n DESC, l_orderkey ASC NULLS FIRST, l_linenumber ASC NULLS FIRST LIMIT 10
""")
def duplicate_top(spark, d):
    """A2: the ten most repeated line keys (a top-k report)."""
    return dedupe.top_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], 10)


@check("duplicates_by_source", """
WITH ks AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER (PARTITION BY l_orderkey, l_linenumber) AS tot FROM ks)
SELECT l_orderkey, l_linenumber, l_returnflag, CAST(n AS BIGINT) AS n, CAST(tot AS BIGINT) AS key_rows FROM t WHERE tot > 1
""")
def duplicates_by_source(spark, d):
    """A3: rows per return flag ("source") for every repeated line key."""
    return dedupe.duplicates_by_source(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_returnflag")


# ---------------------------------------------------------------- enrichment

ENRICH_FILL_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
       CASE WHEN lower(CAST(p.p_name AS VARCHAR)) = 'nan' THEN '' ELSE coalesce(CAST(p.p_name AS VARCHAR), '') END AS master_p_name,
       CASE WHEN lower(CAST(p.p_brand AS VARCHAR)) = 'nan' THEN '' ELSE coalesce(CAST(p.p_brand AS VARCHAR), '') END AS master_p_brand,
       p.p_partkey IS NOT NULL AS matched
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""


def _enrich_fill(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return enrich.fill(li, table(spark, d, "part"), on="l_partkey", cols=["p_name", "p_brand"],
                       dim_key="p_partkey", prefix="master_", flag="matched")


@check("enrich_fill", ENRICH_FILL_SQL)
def enrich_fill(spark, d):
    """Master columns added to every line; unmatched -> ''."""
    return _enrich_fill(spark, d)


@check("match_rate", f"""
WITH e AS ({ENRICH_FILL_SQL})
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE matched) AS BIGINT) AS matched,
       CAST(count(*) - count(*) FILTER (WHERE matched) AS BIGINT) AS unmatched,
       CAST(round(CAST(count(*) FILTER (WHERE matched) * 100.0 / count(*) AS DECIMAL(20,6)), 2) AS DECIMAL(6,2)) AS matched_pct
FROM e
""")
def match_rate(spark, d):
    """A4 over the fill enrichment."""
    return enrich.match_rate(_enrich_fill(spark, d), "matched")


@check("enrich_longest_name", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'p' || CAST(l_partkey AS VARCHAR) END AS own_name
           FROM lineitem)
SELECT f.l_orderkey, f.l_linenumber, f.own_name,
       CASE WHEN p.p_name IS NOT NULL AND trim(p.p_name) <> ''
                 AND (f.own_name IS NULL OR trim(f.own_name) = '' OR length(p.p_name) > length(f.own_name))
            THEN p.p_name ELSE f.own_name END AS product_name
FROM f LEFT JOIN part p ON f.l_partkey = p.p_partkey
""")
def enrich_longest_name(spark, d):
    """The master name replaces the line's own name when it is longer."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("p"), F.col("l_partkey").cast("string"))).alias("own_name"))
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("m_name"))
    j = enrich.fill(li, part, on="l_partkey", cols=["m_name"], dim_key="p_partkey")
    return j.select("l_orderkey", "l_linenumber", "own_name",
                    enrich.prefer_longer("own_name", F.when(F.col("m_name") != "", F.col("m_name"))).alias("product_name"))


def _catalog_key_sql(col: str) -> str:
    return f"lpad(CAST({col} AS VARCHAR), 13, '0')"


def _clean_sql(x: str) -> str:
    t = f"regexp_replace(trim(CAST({x} AS VARCHAR), ' ' || chr(9) || chr(12288)), '\\.0$', '')"
    return f"CASE WHEN {t} = '' OR lower({t}) IN ('nan', 'none', 'null') THEN NULL ELSE {t} END"


LOOKUP_CODE_SQL = f"""
CASE l_linenumber
  WHEN 1 THEN {_catalog_key_sql('l_partkey')}
  WHEN 2 THEN CAST(l_partkey AS VARCHAR)
  WHEN 3 THEN chr(9) || {_catalog_key_sql('l_partkey')} || '.0' || chr(12288)
  WHEN 4 THEN left({_catalog_key_sql('l_partkey')}, 12)
  WHEN 5 THEN {_catalog_key_sql('l_partkey')} || '7'
  WHEN 6 THEN ''
  ELSE 'nan' END"""


def _lookup_code(c):
    key = F.lpad(F.col(c).cast("string"), 13, "0")
    ln = F.col("l_linenumber")
    return (F.when(ln == 1, key).when(ln == 2, F.col(c).cast("string"))
            .when(ln == 3, F.concat(F.lit("\t"), key, F.lit(".0\u3000"))).when(ln == 4, F.substring(key, 1, 12))
            .when(ln == 5, F.concat(key, F.lit("7"))).when(ln == 6, F.lit("")).otherwise(F.lit("nan")))


@check("lookup_cascade", f"""
WITH m AS (SELECT {_catalog_key_sql('p_partkey')} AS k, min(p_partkey) AS pos FROM part GROUP BY 1),
f AS (SELECT l_orderkey, l_linenumber, {LOOKUP_CODE_SQL} AS code FROM lineitem),
c AS (SELECT DISTINCT {_clean_sql('code')} AS code FROM f WHERE {_clean_sql('code')} IS NOT NULL),
cand AS (
  SELECT code, 1 AS prio, code AS cand FROM c
  UNION ALL SELECT code, 2, lpad(code, 15, '0') FROM c WHERE length(code) < 15
  UNION ALL SELECT code, 3, rpad(code, 15, '0') FROM c WHERE length(code) < 15
  UNION ALL SELECT code, 4, rpad(CASE WHEN length(code) < 14 THEN lpad(code, 14, '0') ELSE code END, 15, '0') FROM c WHERE length(code) < 15
  UNION ALL SELECT code, 5, ltrim(code, '0') FROM c WHERE ltrim(code, '0') <> '' AND ltrim(code, '0') <> code
  UNION ALL SELECT code, CAST(6 + 2 * (w - 10) AS INTEGER), lpad(code, CAST(w AS INTEGER), '0') FROM c, range(10, 16) t(w) WHERE length(code) < w
  UNION ALL SELECT code, CAST(7 + 2 * (w - 10) AS INTEGER), rpad(code, CAST(w AS INTEGER), '0') FROM c, range(10, 16) t(w) WHERE length(code) < w),
ex AS (SELECT code, arg_min(cand, prio) AS mkey, min(prio) AS stage FROM cand JOIN m ON cand.cand = m.k GROUP BY code),
rest AS (SELECT code FROM c WHERE code NOT IN (SELECT code FROM ex) AND length(code) >= 8),
pf AS (SELECT r.code, arg_min(m.k, m.pos) AS mkey, 18 AS stage FROM rest r JOIN m
       ON starts_with(m.k, r.code) OR starts_with(r.code, m.k) GROUP BY r.code),
res AS (SELECT * FROM ex UNION ALL SELECT * FROM pf)
SELECT f.l_orderkey, f.l_linenumber, f.code, res.mkey AS matched_key, CAST(res.stage AS BIGINT) AS match_stage
FROM f LEFT JOIN res ON {_clean_sql('f.code')} = res.code
""")
def lookup_cascade(spark, d):
    """J8 + J9 + J13: product codes in seven spellings (exact, unpadded, ``.0``,
    cut, extended, blank, ``nan``) resolved against a zero-padded catalog."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _lookup_code("l_partkey").alias("code"))
    catalog = table(spark, d, "part").select(F.lpad(F.col("p_partkey").cast("string"), 13, "0").alias("k"),
                                             F.col("p_partkey").alias("pos"))
    r = enrich.lookup_cascade(li, catalog, "code", "k", "pos", out="matched_key", stage="match_stage")
    return r.withColumn("match_stage", F.col("match_stage").cast("bigint"))


@check("lookup_multi_key", f"""
WITH m AS (SELECT DISTINCT {_catalog_key_sql('p_partkey')} AS k FROM part),
f AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber % 2 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR) ELSE {_catalog_key_sql('l_partkey')} END AS c1,
             CASE WHEN l_linenumber % 3 = 0 THEN {_catalog_key_sql('l_partkey + 1')} ELSE 'bad' END AS c2,
             {_catalog_key_sql('l_partkey')} || '.0' AS c3
      FROM lineitem)
SELECT f.l_orderkey, f.l_linenumber, f.c1, f.c2, f.c3, coalesce(m1.k, m2.k, m3.k) AS matched_key
FROM f LEFT JOIN m m1 ON {_clean_sql('f.c1')} = m1.k
       LEFT JOIN m m2 ON {_clean_sql('f.c2')} = m2.k
       LEFT JOIN m m3 ON {_clean_sql('f.c3')} = m3.k
""")
def lookup_multi_key(spark, d):
    """Three code columns tried in order; the first that matches wins."""
    key = lambda c: F.lpad(c.cast("string"), 13, "0")
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("X"), F.col("l_partkey").cast("string")))
        .otherwise(key(F.col("l_partkey"))).alias("c1"),
        F.when(F.col("l_linenumber") % 3 == 0, key(F.col("l_partkey") + 1)).otherwise(F.lit("bad")).alias("c2"),
        F.concat(key(F.col("l_partkey")), F.lit(".0")).alias("c3"))
    catalog = table(spark, d, "part").select(key(F.col("p_partkey")).alias("k"))
    return enrich.lookup_multi(li, catalog, "k", ["c1", "c2", "c3"], out="matched_key")


@check("casefold_join", """
WITH m AS (SELECT lower(trim(c_mktsegment)) AS ck, arg_max(c_custkey, c_custkey) AS shop_shop_id,
                  arg_max(c_name, c_custkey) AS shop_shop_name
           FROM customer WHERE lower(trim(c_mktsegment)) IS NOT NULL AND lower(trim(c_mktsegment)) <> '' GROUP BY 1),
f AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment)
                                           WHEN 1 THEN chr(12288) || lower(c_mktsegment) || chr(9)
                                           ELSE c_mktsegment END AS platform FROM customer)
SELECT f.c_custkey, f.platform, m.shop_shop_id, m.shop_shop_name FROM f LEFT JOIN m ON lower(trim(f.platform, ' ' || chr(9) || chr(12288))) = m.ck
""")
def casefold_join(spark, d):
    """Platform text in mixed case/padding joined on lower(trim(...));
    the last master row per platform wins."""
    cust = table(spark, d, "customer")
    fact = cust.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.upper("c_mktsegment"))
                       .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("\u3000"), F.lower("c_mktsegment"), F.lit("\t")))
                       .otherwise(F.col("c_mktsegment")).alias("platform"))
    master = cust.select(F.col("c_mktsegment").alias("platform"), F.col("c_custkey").alias("shop_id"),
                         F.col("c_name").alias("shop_name"), F.col("c_custkey").alias("position"))
    return enrich.casefold_join(fact, master, "platform", "platform", ["shop_id", "shop_name"], "position")


@check("attach_single", """
SELECT o_orderkey, o_custkey,
       (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7' ORDER BY n_nationkey, n_name LIMIT 1) AS shop_n_nationkey,
       (SELECT n_name FROM nation WHERE n_name = 'NATION_7' ORDER BY n_nationkey, n_name LIMIT 1) AS shop_n_name
FROM orders
""")
def attach_single(spark, d):
    """One shop (nation) stamped on every order row."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return enrich.attach_single(o, table(spark, d, "nation"), F.col("n_name") == "NATION_7",
                                ["n_nationkey", "n_name"], prefix="shop_")


# ---------------------------------------------------------------- text cleaning

# every white space character, Unicode ones included
WS_SQL = "'[\\t-\\r\\x1c- \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'"
CTRL_SQL = "'[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]'"


def _ws_sql(x):
    return f"trim(regexp_replace({x}, {WS_SQL}, ' ', 'g'))"


def _nl_sql(x):
    return f"trim(regexp_replace(regexp_replace({x}, '[\\r\\n]', '', 'g'), {WS_SQL}, ' ', 'g'))"


NULL_TOKENS_SQL = "('nan', 'None', 'NULL', 'null', 'NaN', 'NAN', 'NaT', 'Null')"


@check("clean_text", f"""
SELECT doc_id, {_ws_sql('text')} AS text_ws, {_nl_sql('text')} AS text_nl,
       regexp_replace(text, {CTRL_SQL}, '', 'g') AS text_ctrl,
       CASE WHEN trim(lang) IN {NULL_TOKENS_SQL} THEN NULL ELSE lang END AS lang_clean
FROM documents
""")
def clean_text(spark, d):
    """T1 + T2 + T12 + T3 over whole document texts."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", fn.normalize_ws("text").alias("text_ws"), fn.strip_newlines("text").alias("text_nl"),
                       fn.strip_control_chars("text").alias("text_ctrl"), fn.null_tokens("lang").alias("lang_clean"))


@check("clean_change_count", f"""
WITH c AS (
  SELECT count(*) FILTER (WHERE text IS DISTINCT FROM {_ws_sql('text')}) AS c0,
         count(*) FILTER (WHERE lang IS DISTINCT FROM (CASE WHEN trim(lang) IN {NULL_TOKENS_SQL} THEN NULL ELSE lang END)) AS c1,
         count(*) FILTER (WHERE source IS DISTINCT FROM {_ws_sql('source')}) AS c2
  FROM documents)
SELECT 'text' AS "column", CAST(c0 AS BIGINT) AS changed_cells FROM c
UNION ALL SELECT 'lang', CAST(c1 AS BIGINT) FROM c
UNION ALL SELECT 'source', CAST(c2 AS BIGINT) FROM c
UNION ALL SELECT '*total*', CAST(c0 + c1 + c2 AS BIGINT) FROM c
""")
def clean_change_count(spark, d):
    """Cells changed by cleaning, per column and in total."""
    docs = table(spark, d, "documents")
    return quality.changed_cells(docs, {"text": fn.normalize_ws("text"), "lang": fn.null_tokens("lang"),
                                        "source": fn.normalize_ws("source")})


@check("clean_pages", f"""
SELECT page_id, {_ws_sql("regexp_replace(html, " + CTRL_SQL + ", '', 'g')")} AS html_clean,
       length(html) AS html_chars
FROM pages
""")
def clean_pages(spark, d):
    """T12 + T1 over whole raw HTML pages."""
    p = table(spark, d, "pages")
    return p.select("page_id", fn.normalize_ws(fn.strip_control_chars("html")).alias("html_clean"),
                    F.length("html").alias("html_chars"))


# ---------------------------------------------------------------- codes / ids

@check("clean_codes", f"""
SELECT o_orderkey,
       regexp_replace(CAST(o_orderkey AS VARCHAR) || '.0', '\\.0+$', '') AS key_no_suffix,
       split_part(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', 1) AS price_int_part,
       CASE WHEN length(CAST(o_orderkey % 1000 AS VARCHAR)) < 5 THEN lpad(CAST(o_orderkey % 1000 AS VARCHAR), 5, '0') ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS key_zfill,
       CASE WHEN length(CAST(o_custkey AS VARCHAR)) < 8 THEN rpad(CAST(o_custkey AS VARCHAR), 8, '0') ELSE CAST(o_custkey AS VARCHAR) END AS cust_rpad,
       CAST(o_orderkey AS VARCHAR) AS key_unquoted, CAST(o_orderkey AS VARCHAR) AS key_clean,
       '''' || CAST(o_orderkey AS VARCHAR) AS key_guarded,
       '''0' || regexp_replace('9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '.0', '\\.0$', '') AS phone_prefixed,
       CASE WHEN regexp_matches(regexp_replace('9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '.0', '\\.0$', ''), '^9[0-9]{{8}}$')
            THEN '0' || regexp_replace('9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '.0', '\\.0$', '')
            ELSE regexp_replace('9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '.0', '\\.0$', '') END AS phone_nine,
       trim(regexp_replace(o_orderpriority || ' 無 ' || o_orderstatus, '無.*$', '')) AS note_cut,
       left(CAST(o_custkey + 10000 AS VARCHAR), 3) AS zip3,
       regexp_replace(lpad(CAST(o_orderkey AS VARCHAR), 10, '0'), '^0+', '') AS key_unpadded,
       CASE WHEN regexp_matches(CAST(o_custkey AS VARCHAR) || '.00', '^-?[0-9]+\\.0+$')
            THEN regexp_replace(CAST(o_custkey AS VARCHAR) || '.00', '\\.0+$', '') ELSE CAST(o_custkey AS VARCHAR) || '.00' END AS cust_integral
FROM orders
""")
def clean_codes(spark, d):
    """T4-T11, T17, T18 on id text derived from every order."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey").cast("string")
    phone_raw = F.concat(F.lit("9"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit(".0"))
    return o.select(
        "o_orderkey",
        fn.strip_float_suffix(F.concat(k, F.lit(".0"))).alias("key_no_suffix"),
        fn.strip_float_suffix(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), mode="cut").alias("price_int_part"),
        fn.zero_pad((F.col("o_orderkey") % 1000).cast("string"), 5).alias("key_zfill"),
        fn.pad_right(F.col("o_custkey").cast("string"), 8).alias("cust_rpad"),
        fn.unquote_formula(F.concat(F.lit('\u3000="'), k, F.lit('"\t'))).alias("key_unquoted"),
        fn.clean_code(F.concat(F.lit("\t"), k, F.lit(".0\u3000"))).alias("key_clean"),
        fn.text_guard_prefix(k).alias("key_guarded"),
        fn.format_phone(phone_raw).alias("phone_prefixed"),
        fn.format_phone(phone_raw, "nine").alias("phone_nine"),
        fn.truncate_at_word(F.concat(F.col("o_orderpriority"), F.lit(" 無 "), F.col("o_orderstatus"))).alias("note_cut"),
        fn.zip_prefix(F.concat(F.lit("\u3000\t"), (F.col("o_custkey") + 10000).cast("string"))).alias("zip3"),
        fn.strip_leading_zeros(F.lpad(k, 10, "0")).alias("key_unpadded"),
        fn.integral_text(F.concat(F.col("o_custkey").cast("string"), F.lit(".00"))).alias("cust_integral"),
    )


SPLIT_ID_SQL = """CASE WHEN l_linenumber < 7
  THEN strftime(l_shipdate, '%y%m%d') || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0')
       || '-' || lpad(CAST(CAST(floor(l_quantity) AS BIGINT) % 3 + 1 AS VARCHAR), 3, '0') || '-001'
  ELSE strftime(l_shipdate, '%y%m%d') || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') END"""


@check("split_ids", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, {SPLIT_ID_SQL} AS order_sn FROM lineitem),
p AS (SELECT *, string_split(order_sn, '-') AS parts FROM s)
SELECT l_orderkey, l_linenumber, order_sn,
       parts[1] AS order_main,
       CASE WHEN len(parts) = 4 THEN parts[2] ELSE '001' END AS order_line,
       CASE WHEN len(parts) = 4 THEN parts[3] ELSE '001' END AS order_sub,
       CASE WHEN len(parts) = 4 THEN parts[4] ELSE '001' END AS order_detail,
       coalesce(parts[2], '001') AS lenient_line, coalesce(parts[3], '001') AS lenient_sub,
       coalesce(parts[4], '001') AS lenient_detail,
       length(order_sn) > 17 AND NOT ends_with(order_sn, '001-001') AS abnormal_long,
       NOT (coalesce((CASE WHEN len(parts) = 4 THEN parts[3] ELSE '001' END) = '001', false)
            AND coalesce((CASE WHEN len(parts) = 4 THEN parts[4] ELSE '001' END) = '001', false)) AS abnormal_subseq
FROM p
""")
def split_ids(spark, d):
    """T14 + T15: composite ``YYMMDDnnnnnnnn-line-sub-detail`` ids (two-part
    ids for line 7) split strictly and leniently; both abnormal flags."""
    li = table(spark, d, "lineitem")
    head = F.concat(F.date_format("l_shipdate", "yyMMdd"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0"),
                    F.lit("-"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"))
    det = F.lpad((F.floor("l_quantity").cast("bigint") % 3 + 1).cast("string"), 3, "0")
    sn = F.when(F.col("l_linenumber") < 7, F.concat(head, F.lit("-"), det, F.lit("-001"))).otherwise(head)
    s = li.select("l_orderkey", "l_linenumber", sn.alias("order_sn"))
    s = s.withColumn("st", fn.split_composite_id("order_sn")).withColumn("le", fn.split_composite_id("order_sn", strict=False))
    return s.select("l_orderkey", "l_linenumber", "order_sn", "st.order_main", "st.order_line", "st.order_sub",
                    "st.order_detail", F.col("le.order_line").alias("lenient_line"),
                    F.col("le.order_sub").alias("lenient_sub"), F.col("le.order_detail").alias("lenient_detail"),
                    fn.is_abnormal_long("order_sn").alias("abnormal_long"),
                    fn.is_abnormal_subseq("st.order_sub", "st.order_detail").alias("abnormal_subseq"))


# ---------------------------------------------------------------- dates

def _ymd_sql():
    y = "CAST(year(o_orderdate) AS VARCHAR)"
    m = "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')"
    dd = "lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')"
    return y, m, dd


def _rendered_sql():
    y, m, dd = _ymd_sql()
    return f"""CASE o_orderkey % 9
  WHEN 0 THEN {y} || '-' || {m} || '-' || {dd}
  WHEN 1 THEN {y} || '/' || {m} || '/' || {dd}
  WHEN 2 THEN {y} || '-' || {m} || '-' || {dd} || ' 10:20:30'
  WHEN 3 THEN {y} || '/' || {m} || '/' || {dd} || ' 10:20:30'
  WHEN 4 THEN {y} || '-' || {m} || '-' || {dd} || ' 10:20'
  WHEN 5 THEN {y} || '/' || {m} || '/' || {dd} || ' 10:20'
  WHEN 6 THEN {dd} || '/' || {m} || '/' || {y}
  WHEN 7 THEN {m} || '/' || {dd} || '/' || {y}
  ELSE {y} || {m} || {dd} END"""


def _rendered():
    dt = F.col("o_orderdate")
    y = F.year(dt).cast("string")
    m = F.lpad(F.month(dt).cast("string"), 2, "0")
    dd = F.lpad(F.dayofmonth(dt).cast("string"), 2, "0")
    k = F.col("o_orderkey") % 9
    forms = [F.concat(y, F.lit("-"), m, F.lit("-"), dd), F.concat(y, F.lit("/"), m, F.lit("/"), dd),
             F.concat(y, F.lit("-"), m, F.lit("-"), dd, F.lit(" 10:20:30")),
             F.concat(y, F.lit("/"), m, F.lit("/"), dd, F.lit(" 10:20:30")),
             F.concat(y, F.lit("-"), m, F.lit("-"), dd, F.lit(" 10:20")),
             F.concat(y, F.lit("/"), m, F.lit("/"), dd, F.lit(" 10:20")),
             F.concat(dd, F.lit("/"), m, F.lit("/"), y), F.concat(m, F.lit("/"), dd, F.lit("/"), y)]
    e = F.when(k == 0, forms[0])
    for i in range(1, 8):
        e = e.when(k == i, forms[i])
    return e.otherwise(F.concat(y, m, dd))


PATTERNS_SQL = ["%Y-%m-%d", "%Y/%m/%d", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M",
                "%Y/%m/%d %H:%M", "%d/%m/%Y", "%m/%d/%Y", "%Y%m%d"]


def _multi_ts_sql(x, pats=PATTERNS_SQL):
    return "coalesce(" + ", ".join(f"try_strptime(trim({x}), '{p}')" for p in pats) + ")"


SLASH3 = "'^ *([0-9]+)/([0-9]+)/([0-9]+) *$'"


def _dash_date_sql(x):
    fmt = (f"printf('%04d-%02d-%02d', CAST(regexp_extract({x}, {SLASH3}, 1) AS INTEGER), "
           f"CAST(regexp_extract({x}, {SLASH3}, 2) AS INTEGER), CAST(regexp_extract({x}, {SLASH3}, 3) AS INTEGER))")
    return (f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '' "
            f"WHEN contains({x}, '/') AND len(string_split({x}, '/')) = 3 AND regexp_matches({x}, {SLASH3}) THEN {fmt} "
            f"WHEN contains({x}, '/') AND len(string_split({x}, '/')) = 3 THEN '' ELSE {x} END")


def _dash_datetime_sql(x):
    dp = f"split_part({x}, ' ', 1)"
    fmt = (f"printf('%04d-%02d-%02d', CAST(regexp_extract({dp}, {SLASH3}, 1) AS INTEGER), "
           f"CAST(regexp_extract({dp}, {SLASH3}, 2) AS INTEGER), CAST(regexp_extract({dp}, {SLASH3}, 3) AS INTEGER))")
    with_time = (f"CASE WHEN len(string_split({dp}, '/')) <> 3 THEN {x} "
                 f"WHEN regexp_matches({dp}, {SLASH3}) THEN {fmt} || ' ' || substr({x}, instr({x}, ' ') + 1) ELSE '' END")
    return (f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '' WHEN NOT contains({x}, '/') THEN {x} "
            f"WHEN contains({x}, ' ') THEN {with_time} ELSE {_dash_date_sql(x)} END")


ID_SQL = ("strftime(o_orderdate, '%y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 8, '0')")


@check("parse_dates", f"""
WITH s AS (SELECT o_orderkey, {_rendered_sql()} AS date_text,
                  CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || ' 上午 12:00:00' AS ampm_text,
                  {ID_SQL} AS order_id, o_orderdate
           FROM orders)
SELECT o_orderkey, date_text,
       CAST({_multi_ts_sql('date_text')} AS DATE) AS parsed_date,
       {_dash_date_sql('date_text')} AS dash_date,
       {_dash_datetime_sql('date_text')} AS dash_datetime,
       strftime({_multi_ts_sql('date_text')}, '%H:%M:%S') AS time_part,
       CASE WHEN contains(trim(ampm_text), '上午') OR contains(trim(ampm_text), '下午')
            THEN coalesce(CAST(try_strptime(trim(regexp_extract(trim(ampm_text), '^(.*?)(上午|下午)', 1)), '%Y/%m/%d') AS DATE),
                          CAST({_multi_ts_sql('ampm_text')} AS DATE))
            ELSE CAST({_multi_ts_sql('ampm_text')} AS DATE) END AS ampm_date,
       CASE WHEN regexp_matches(substr(order_id, 1, 6), '^[0-9]{{6}}$')
            THEN '20' || substr(order_id, 1, 2) || '-' || substr(order_id, 3, 2) || '-' || substr(order_id, 5, 2) ELSE '' END AS id_date_text,
       CASE WHEN length('RM' || order_id) >= 6 AND regexp_matches(substr('RM' || order_id, 3, 6), '^[0-9]{{6}}$')
            THEN '20' || substr(order_id, 1, 2) || '/' || substr(order_id, 3, 2) || '/' || substr(order_id, 5, 2) ELSE '' END AS prefixed_id_date,
       CAST(try_strptime(substr(strftime(o_orderdate, '%Y%m%d') || CAST(o_orderkey AS VARCHAR), 1, 8), '%Y%m%d') AS DATE) AS id8_date,
       coalesce(strftime(coalesce(try_strptime(trim(date_text), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(date_text), '%Y-%m-%d %H:%M'),
                                  try_strptime(trim(date_text), '%Y-%m-%d'), try_strptime(trim(date_text), '%Y/%m/%d %H:%M:%S'),
                                  try_strptime(trim(date_text), '%Y/%m/%d %H:%M'), try_strptime(trim(date_text), '%Y/%m/%d')), '%Y-%m-%d'), '') AS ts_date_text
FROM s
""")
def parse_dates(spark, d):
    """Every order date rendered in one of nine layouts (by key),
    parsed back; slash dates re-dashed; id-embedded dates decoded."""
    o = table(spark, d, "orders")
    ampm = F.concat(F.year("o_orderdate").cast("string"), F.lit("/"), F.month("o_orderdate").cast("string"), F.lit("/"),
                    F.dayofmonth("o_orderdate").cast("string"), F.lit(" 上午 12:00:00"))
    oid = F.concat(F.date_format("o_orderdate", "yyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    s = o.select("o_orderkey", _rendered().alias("date_text"), ampm.alias("ampm_text"), oid.alias("order_id"),
                 F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.col("o_orderkey").cast("string")).alias("id8"))
    # the multi-layout timestamp feeds two outputs: parse it once, in its own projection
    s = s.withColumn("__ts", fn.parse_timestamp_multi("date_text"))
    return s.select(
        "o_orderkey", "date_text", F.to_date("__ts").alias("parsed_date"),
        fn.dash_date("date_text").alias("dash_date"), fn.dash_datetime("date_text").alias("dash_datetime"),
        F.date_format("__ts", "HH:mm:ss").alias("time_part"),
        fn.parse_ampm_local("ampm_text").alias("ampm_date"),
        fn.date_from_id_yymmdd("order_id").alias("id_date_text"),
        fn.date_from_id_prefixed(F.concat(F.lit("RM"), F.col("order_id"))).alias("prefixed_id_date"),
        fn.date_from_id_yyyymmdd("id8").alias("id8_date"),
        fn.date_from_timestamp("date_text").alias("ts_date_text"))


WEEKDAY_SQL = "['星期一', '星期二', '星期三', '星期四', '星期五', '星期六', '星期日']"


@check("calendar_parts", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS weekday_sun1,
       CAST(weekofyear(o_orderdate) AS BIGINT) AS iso_week,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_first,
       last_day(CAST(o_orderdate AS DATE)) AS month_last,
       strftime(o_orderdate, '%Y-%m') AS year_month,
       list_extract({WEEKDAY_SQL}, ((dayofweek(o_orderdate) + 6) % 7) + 1) AS weekday_label
FROM orders
""")
def calendar_parts(spark, d):
    """D8-D11, D13 for every order date (month bounds via YYYYMM text)."""
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    mb = fn.month_bounds(F.date_format("day", "yyyyMM"))
    return o.select("o_orderkey", "day", fn.weekday_sun1("day").cast("bigint").alias("weekday_sun1"),
                    fn.iso_week("day").cast("bigint").alias("iso_week"), mb.first_day.alias("month_first"),
                    mb.last_day.alias("month_last"), fn.year_month("day").alias("year_month"),
                    fn.weekday_label("day").alias("weekday_label"))


# ---------------------------------------------------------------- numbers / booleans

#: Some characters that count as white space at a cell's ends.
BLANKS_SQL = "' ' || chr(9) || chr(160) || chr(12288)"

NUM_TEXT_SQL = """CASE l_linenumber
  WHEN 1 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
  WHEN 2 THEN 'nan'
  WHEN 3 THEN CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.0'
  WHEN 4 THEN 'abc'
  WHEN 5 THEN chr(9) || CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) || chr(12288)
  WHEN 6 THEN ''
  ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,3)) AS VARCHAR) END"""
BOOL_TEXT_SQL = """CASE l_linenumber WHEN 1 THEN 'Yes' WHEN 2 THEN '是' || chr(12288) WHEN 3 THEN '0' WHEN 4 THEN chr(160) || 'y' || chr(9)
  WHEN 5 THEN 'TRUE' WHEN 6 THEN NULL ELSE 'no' END"""


@check("numbers_bools", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {NUM_TEXT_SQL} AS num_text, {BOOL_TEXT_SQL} AS bool_text FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, num_text, bool_text,
       CASE WHEN isnan(TRY_CAST(trim(num_text, {BLANKS_SQL}) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(num_text, {BLANKS_SQL}) AS DOUBLE) END AS as_number,
       CAST(round_even(TRY_CAST(trim(num_text, {BLANKS_SQL}) AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)) AS as_money,
       coalesce(TRY_CAST(split_part(trim(num_text, {BLANKS_SQL}), '.', 1) AS BIGINT), 0) AS as_int,
       regexp_replace(trim(num_text, {BLANKS_SQL}), '\\.0+$', '') AS compact,
       coalesce(lower(trim(bool_text, {BLANKS_SQL})) IN ('true', '1', 'yes', 'y', '是'), false) AS bool_tokens,
       CASE WHEN lower(trim(bool_text, {BLANKS_SQL})) IN ('true', '1', 'yes') THEN true ELSE false END AS bool_mapped,
       coalesce(trim(bool_text, {BLANKS_SQL}) = '是', false) AS bool_label
FROM t
""")
def numbers_bools(spark, d):
    """N1-N4, B1-B3 over number and flag text derived from every line."""
    li = table(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    num = (F.when(ln == 1, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
           .when(ln == 2, F.lit("nan"))
           .when(ln == 3, F.concat(F.floor("l_quantity").cast("bigint").cast("string"), F.lit(".0")))
           .when(ln == 4, F.lit("abc"))
           .when(ln == 5, F.concat(F.lit("\t"), F.col("l_discount").cast("decimal(18,2)").cast("string"), F.lit("\u3000")))
           .when(ln == 6, F.lit(""))
           .otherwise((F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(0.5).cast("decimal(1,1)")).cast("decimal(18,3)").cast("string")))
    boo = (F.when(ln == 1, F.lit("Yes")).when(ln == 2, F.lit("是\u3000")).when(ln == 3, F.lit("0"))
           .when(ln == 4, F.lit("\xa0y\t")).when(ln == 5, F.lit("TRUE")).when(ln == 6, F.lit(None).cast("string"))
           .otherwise(F.lit("no")))
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", num.alias("num_text"), boo.alias("bool_text"))
    return t.select("*", fn.to_number("num_text").alias("as_number"), fn.money2("num_text").alias("as_money"),
                    fn.to_int_zero("num_text").alias("as_int"), fn.compact_number("num_text").alias("compact"),
                    fn.bool_true_tokens("bool_text").alias("bool_tokens"), fn.bool_map("bool_text").alias("bool_mapped"),
                    fn.bool_equals_label("bool_text", "是").alias("bool_label"))


# ---------------------------------------------------------------- profiles

NULL_PROFILE_COLUMNS = ["order_key", "line_no", "line_uid", "order_status", "order_date", "ship_date", "report_date",
                        "part_key", "quantity", "extended_price", "product_name", "brand", "source"]


def _null_profile_sql():
    rec = ORACLES["order_reconcile"]
    parts = [f"SELECT '{c}' AS \"column\", CAST({i} AS BIGINT) AS position, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
             f"CAST(round(CAST((count(*) - count(*) FILTER (WHERE {c} IS NULL)) * 100.0 / count(*) AS DECIMAL(20,6)), 2) AS DECIMAL(6,2)) AS non_null_pct FROM r"
             for i, c in enumerate(NULL_PROFILE_COLUMNS)]
    return f"WITH r AS ({rec}) SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE null_count > 0"


@check("null_profile", _null_profile_sql())
def null_profile(spark, d):
    """A8 over the reconciled order-line table."""
    return quality.null_profile(order_reconcile(spark, d))


@check("value_distribution", """
SELECT * FROM (SELECT 'p_brand' AS "column", p_brand AS value, CAST(count(*) AS BIGINT) AS n FROM part
               GROUP BY p_brand ORDER BY n DESC, value ASC NULLS FIRST LIMIT 5)
UNION ALL
SELECT 'p_type', p_type, CAST(count(*) AS BIGINT) FROM part GROUP BY p_type
""")
def value_distribution(spark, d):
    """Top five brands and the full type distribution."""
    p = table(spark, d, "part")
    b = quality.value_counts(p, "p_brand", 5).select(F.lit("p_brand").alias("column"), F.col("p_brand").alias("value"), "n")
    t = quality.value_counts(p, "p_type").select(F.lit("p_type").alias("column"), F.col("p_type").alias("value"), "n")
    return b.unionByName(t)


@check("order_summary", """
SELECT CAST(count(*) AS BIGINT) AS rows, min(CAST(l_shipdate AS DATE)) AS first_date, max(CAST(l_shipdate AS DATE)) AS last_date,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
       CAST(count(DISTINCT l_partkey) AS BIGINT) AS distinct_products, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS distinct_orders
FROM lineitem
""")
def order_summary(spark, d):
    """A5 + A6: date range, exact amount total, distinct products and orders."""
    return quality.order_summary(table(spark, d, "lineitem"), "l_shipdate", "l_extendedprice", "l_orderkey", "l_partkey")


@check("profile_part", """
WITH kv AS (
  SELECT 'p_partkey' AS "column", CAST(p_partkey AS VARCHAR) AS value FROM part
  UNION ALL SELECT 'p_name', p_name FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part
  UNION ALL SELECT 'p_type', p_type FROM part
  UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT 'p_retailprice', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) FROM part)
SELECT "column", CAST(count(value) AS BIGINT) AS non_null, CAST(count(DISTINCT value) AS BIGINT) AS distinct_values,
       min(value) AS sample_min, max(value) AS sample_max
FROM kv GROUP BY 1
""")
def profile_part(spark, d):
    """Per-column non-null / distinct counts and min/max samples of part."""
    p = table(spark, d, "part").withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(18,2)"))
    return quality.profile(p, hashed_sample=False).select("column", "non_null", "distinct_values", "sample_min", "sample_max")


@check("date_validity", f"""
WITH t AS (SELECT o_orderpriority AS file,
                  CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' WHEN o_orderkey % 13 = 0 THEN '' ELSE {_rendered_sql()} END AS date_text
           FROM orders),
p AS (SELECT file, CAST({_multi_ts_sql('date_text')} AS DATE) IS NOT NULL AS ok FROM t),
a AS (SELECT file, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS valid,
             CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS invalid FROM p GROUP BY file
      UNION ALL
      SELECT NULL, CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE ok) AS BIGINT), CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) FROM p)
SELECT *, CAST(round(CAST(valid * 100.0 / rows AS DECIMAL(20,6)), 2) AS DECIMAL(6,2)) AS valid_pct FROM a
""")
def date_validity(spark, d):
    """Parse rate of date text per order priority ("file") and overall."""
    o = table(spark, d, "orders")
    txt = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("not a date"))
           .when(F.col("o_orderkey") % 13 == 0, F.lit("")).otherwise(_rendered()))
    t = o.select("o_orderpriority", txt.alias("date_text"))
    return cal.date_validity(t, fn.parse_date_multi("date_text"), "o_orderpriority")


@check("missing_dates_by_file", """
WITH t AS (SELECT o_orderpriority AS file, CAST(o_orderdate AS DATE) AS day FROM orders
           WHERE (dayofyear(o_orderdate) + length(o_orderpriority)) % 11 <> 0 AND (o_orderpriority <> '5-LOW' OR o_orderkey % 3 = 0)
                 AND dayofyear(o_orderdate) <> 100),
s AS (SELECT file, min(day) AS lo, max(day) AS hi FROM t GROUP BY file),
f AS (SELECT file, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM s EXCEPT SELECT file, day FROM t),
a AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM t EXCEPT SELECT day FROM t)
SELECT 'file' AS scope, file, day FROM f UNION ALL SELECT DISTINCT 'any', NULL, day FROM f UNION ALL SELECT 'all', NULL, day FROM a
""")
def missing_dates_by_file(spark, d):
    """A12 + W8: days missing in each file (order priority), in any of them, and
    in all, by day bitmaps from one pass over the orders."""
    o = table(spark, d, "orders")
    late = (F.dayofyear("o_orderdate") + F.length("o_orderpriority")) % 11 != 0
    kept = o.filter(late & ((F.col("o_orderpriority") != "5-LOW") | (F.col("o_orderkey") % 3 == 0))
                    & (F.dayofyear("o_orderdate") != 100))
    return cal.missing_dates(kept.withColumn("file", F.col("o_orderpriority")), "o_orderdate", "file")


@check("step_counts", f"""
WITH s AS (
  SELECT 'dedupe_lines' AS step, 0 AS pos, (SELECT count(*) FROM lineitem) AS rows_in, (SELECT count(*) FROM ({LINES_LAST_SQL})) AS rows_out
  UNION ALL
  SELECT 'orders_with_lines', 1, (SELECT count(*) FROM orders),
         (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey))),
t AS (SELECT step, pos, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out FROM s
      UNION ALL SELECT '*total*', 2, CAST(sum(rows_in) AS BIGINT), CAST(sum(rows_out) AS BIGINT) FROM s)
SELECT *, CAST(rows_in - rows_out AS BIGINT) AS removed,
       CAST(round(CAST((rows_in - rows_out) * 100.0 / rows_in AS DECIMAL(20,6)), 2) AS DECIMAL(6,2)) AS removed_pct FROM t
""")
def step_counts(spark, d):
    """Rows in/out per cleaning step and in total."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    with_lines = up.member_of(o, li.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return quality.step_counts([("dedupe_lines", li, _lines_keep_last(spark, d)), ("orders_with_lines", o, with_lines)]) \
        .withColumn("pos", F.col("pos").cast("int"))


@check("observed_steps", f"""
WITH a AS (SELECT count(*) AS n FROM lineitem), b AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag <> 'R'),
c AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag <> 'R')),
e AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag <> 'R')
      WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')),
s AS (SELECT 'not_returned' AS step, 0 AS pos, a.n AS rows_in, b.n AS rows_out FROM a, b
      UNION ALL SELECT 'one_per_part', 1, b.n, c.n FROM b, c UNION ALL SELECT 'known_orders', 2, c.n, e.n FROM c, e),
t AS (SELECT * FROM s UNION ALL SELECT '*total*', 3, CAST(sum(rows_in) AS BIGINT), CAST(sum(rows_out) AS BIGINT) FROM s)
SELECT *, rows_in - rows_out AS removed,
       CAST(round(CAST((rows_in - rows_out) * 100.0 / rows_in AS DECIMAL(20,6)), 2) AS DECIMAL(6,2)) AS removed_pct FROM t
""")
def observed_steps(spark, d):
    """Rows in and out of three steps, as metrics of the one job that writes
    their result; every source is scanned once."""
    steps = quality.ObservedSteps()
    li = steps.mark(table(spark, d, "lineitem"), "lines")
    kept = steps.mark(li.filter("l_returnflag <> 'R'"), "not_returned", after="lines")
    one = steps.mark(dedupe.keep_first(kept, ["l_orderkey", "l_partkey"], ["l_linenumber"]), "one_per_part", after="not_returned")
    done = table(spark, d, "orders").filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    known = steps.mark(up.member_of(one, done, "l_orderkey"), "known_orders", after="one_per_part")
    known.write.parquet(scratch_path(spark, f"observed-{uuid.uuid4().hex}"))
    return steps.report(spark)


# ---------------------------------------------------------------- conformance

# Fixed test registry: canonical order-line fields, local header names, types.
LINE_REGISTRY = cf.registry_from_rows([
    {"order": 1, "name": "order_sn", "local_name": "訂單編號", "type": "STRING", "required": "是"},
    {"order": 2, "name": "item_no", "local_name": "項次", "type": "INTEGER", "required": "是"},
    {"order": 3, "name": "product_id", "local_name": "商品編號", "type": "STRING"},
    {"order": 4, "name": "quantity", "local_name": "數量", "type": "INTEGER"},
    {"order": 5, "name": "price", "local_name": "售價", "type": "NUMERIC"},
    {"order": 6, "name": "discount", "local_name": "折扣", "type": "FLOAT"},
    {"order": 7, "name": "is_returned", "local_name": "退貨", "type": "BOOLEAN"},
    {"order": 8, "name": "ship_date", "local_name": "出貨日", "type": "DATE"},
    {"order": 9, "name": "order_status", "local_name": "訂單狀態", "type": "STRING"},
    {"order": 10, "name": "shipping_company", "local_name": "貨運公司", "type": "STRING"},
    {"order": 11, "name": "platform", "local_name": "", "type": "STRING"},
])


@check("conform_order_lines", """
WITH raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS c1, CAST(l_linenumber AS VARCHAR) AS c2, CAST(l_partkey AS VARCHAR) AS c3,
         CAST(l_quantity AS VARCHAR) AS c4, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS c5,
         CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS c6,
         CASE WHEN l_returnflag = 'R' THEN '是' ELSE '否' END AS c7,
         CAST(year(l_shipdate) AS VARCHAR) || '/' || CAST(month(l_shipdate) AS VARCHAR) || '/' || CAST(day(l_shipdate) AS VARCHAR) AS c8,
         l_linestatus AS c9
  FROM lineitem)
SELECT coalesce(c1, '') AS order_sn,
       coalesce(TRY_CAST(regexp_replace(trim(c2), '\\.0+$', '') AS BIGINT), 0) AS item_no,
       coalesce(c3, '') AS product_id,
       coalesce(TRY_CAST(regexp_replace(trim(c4), '\\.0+$', '') AS BIGINT), 0) AS quantity,
       CAST(coalesce(round_even(TRY_CAST(trim(c5) AS DECIMAL(38,10)), 2), 0) AS DECIMAL(18,2)) AS price,
       coalesce(TRY_CAST(trim(c6) AS DOUBLE), 0.0) AS discount,
       coalesce(lower(trim(c7)) IN ('true', '1', 'yes', 'y', '是'), false) AS is_returned,
       CAST(try_strptime(trim(c8), '%Y/%m/%d') AS DATE) AS ship_date,
       coalesce(c9, '') AS order_status,
       '' AS shipping_company,
       'tpch' AS platform
FROM raw
""")
def conform_order_lines(spark, d):
    """P1/P2 + P5 + P6 + P7 + P11: raw all-text line report with local headers
    (plus an unknown company column) renamed by the registry, conformed to the
    canonical typed schema, missing fields defaulted, platform stamped."""
    li = table(spark, d, "lineitem")
    raw = li.select(
        F.col("l_orderkey").cast("string").alias("訂單編號"), F.col("l_linenumber").cast("string").alias("項次"),
        F.col("l_partkey").cast("string").alias("商品編號"), F.col("l_quantity").cast("string").alias("數量"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("售價"),
        F.col("l_discount").cast("decimal(18,2)").cast("string").alias("折扣"),
        F.when(F.col("l_returnflag") == "R", F.lit("是")).otherwise(F.lit("否")).alias("退貨"),
        F.concat_ws("/", F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"),
                    F.dayofmonth("l_shipdate").cast("string")).alias("出貨日"),
        F.col("l_linestatus").alias("訂單狀態"), F.lit("ACME").alias("公司"))
    named = cf.registry_rename(raw, LINE_REGISTRY, unmapped="keep")
    conformed = cf.conform(named, LINE_REGISTRY, extras="drop", drop=["公司"])
    return cf.stamp(conformed, always={"platform": "tpch"})


# cells that a report may hold in a typed column, and what each type makes of them
DIRTY_REGISTRY = [cf.Field("item", 1, type="STRING"), cf.Field("whole", 2, type="INTEGER"), cf.Field("amount", 3, type="NUMERIC"),
                  cf.Field("day", 4, type="DATE")]
DIRTY_WHOLE = ["12345678901234567", "1e30", "7.0", "-3", "99999999999999999999", " 42 ", "x", "", "2.75",
               "12345678901234567.5", "\t43\u3000", "-9007199254740993.99999999999", "2e3"]
DIRTY_AMOUNT = ["99999999999999999999", "1.005", "2.675", "-0.125", "1e3", "", "n/a", "12345678901234.567"]
DIRTY_DAY = ["99999999999/1/1", "2025/7/1", "2025-07-01 10:20", "31/12/2024", "2025/13/40", "", "20250701"]


def _pick_sql(values, key):
    cells = ", ".join(f"'{v}'" for v in values)
    return f"([{cells}])[CAST({key} % {len(values)} AS INTEGER) + 1]"


def _pick(values, key):
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int"))


DIRTY_SQL = f"""SELECT l_orderkey, l_linenumber, {_pick_sql(DIRTY_WHOLE, 'l_orderkey')} AS whole,
       {_pick_sql(DIRTY_AMOUNT, 'l_partkey')} AS amount, {_pick_sql(DIRTY_DAY, 'l_suppkey')} AS day FROM lineitem"""


def _dirty(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", _pick(DIRTY_WHOLE, "l_orderkey").alias("whole"),
        _pick(DIRTY_AMOUNT, "l_partkey").alias("amount"), _pick(DIRTY_DAY, "l_suppkey").alias("day"))


# a whole number is the digits before the point; one with an exponent its integral value; else 0
_WHOLE = "trim(whole, ' ' || chr(9) || chr(12288))"
WHOLE_SQL = f"""coalesce(CASE WHEN regexp_matches({_WHOLE}, '^[+-]?[0-9]+([.][0-9]*)?$')
                   THEN TRY_CAST(regexp_extract({_WHOLE}, '^[+-]?[0-9]+') AS BIGINT)
                   WHEN regexp_matches({_WHOLE}, '^[0-9]e[0-9]$')
                   THEN CAST(left({_WHOLE}, 1) AS BIGINT) * CAST('1' || repeat('0', CAST(right({_WHOLE}, 1) AS INTEGER)) AS BIGINT) END, 0)"""
AMOUNT_SQL = "coalesce(TRY_CAST(round_even(TRY_CAST(trim(amount) AS DECIMAL(38,10)), 2) AS DECIMAL(18,2)), 0)"
DAY_SQL = """CAST(coalesce(try_strptime(day, '%Y-%m-%d'), CASE WHEN length(day) < 11 THEN try_strptime(day, '%Y/%m/%d') END,
                   try_strptime(day, '%Y-%m-%d %H:%M'), try_strptime(day, '%d/%m/%Y'), try_strptime(day, '%m/%d/%Y'),
                   CASE WHEN length(day) = 8 THEN try_strptime(day, '%Y%m%d') END) AS DATE)"""


@check("conform_dirty_cells", f"""
WITH t AS ({DIRTY_SQL})
SELECT l_orderkey, l_linenumber, {WHOLE_SQL} AS whole, {AMOUNT_SQL} AS amount, {DAY_SQL} AS day,
       CASE day WHEN '99999999999/1/1' THEN '99999999999-01-01' WHEN '2025/7/1' THEN '2025-07-01' WHEN '2025/13/40' THEN '2025-13-40'
                WHEN '31/12/2024' THEN '0031-12-2024' ELSE day END AS dashed
FROM t
""")
def conform_dirty_cells(spark, d):
    """P6 + N2 + D2 on cells that don't fit their type: none aborts the job,
    whole numbers keep all digits, unfit ones take the default."""
    t = _dirty(spark, d).withColumn("dashed", fn.dash_date("day"))
    fields = [cf.Field(c, k, type=typ) for k, (c, typ) in enumerate(
        [("whole", "INTEGER"), ("amount", "NUMERIC"), ("day", "DATE")])]
    return cf.conform(t, fields, extras="last").select("l_orderkey", "l_linenumber", "whole", "amount", "day", "dashed")


@check("conform_reject_counts", f"""
WITH t AS ({DIRTY_SQL}), r AS (
SELECT count(*) FILTER (trim(whole) <> '' AND (trim(whole) IN ('x', '1e30', '99999999999999999999'))) AS w,
       count(*) FILTER (trim(amount) <> '' AND trim(amount) IN ('n/a', '99999999999999999999')) AS a,
       count(*) FILTER (trim(day) <> '' AND day IN ('99999999999/1/1', '2025/13/40')) AS d FROM t)
SELECT 'whole' AS field, 'INTEGER' AS type, w AS rejected FROM r UNION ALL SELECT 'amount', 'NUMERIC', a FROM r
UNION ALL SELECT 'day', 'DATE', d FROM r
""")
def conform_reject_counts(spark, d):
    """Cells per field that don't fit the registry's type."""
    return cf.reject_counts(_dirty(spark, d), DIRTY_REGISTRY)


@check("clean_unicode_space", """
WITH t AS (SELECT p_partkey, chr(12288) || replace(p_name, ' ', chr(160) || chr(8195)) || chr(9) || CASE p_partkey % 4 WHEN 0 THEN chr(12288)
                  WHEN 1 THEN chr(10) || 'x' ELSE '' END AS raw, CASE p_partkey % 5 WHEN 0 THEN chr(12288) || chr(9) ELSE p_name END AS key FROM part)
SELECT p_partkey, {ws} AS text_ws, {nl} AS text_nl FROM t WHERE key <> chr(12288) || chr(9)
""".format(ws=_ws_sql("raw"), nl=_nl_sql("raw")))
def clean_unicode_space(spark, d):
    """T1 + T2 + F1: ideographic, no-break and other Unicode spaces collapse like
    ASCII ones, and a key of nothing else is blank."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    wide = F.replace("p_name", F.lit(" "), F.lit("\u00a0\u2003"))
    tail = F.when(k % 4 == 0, F.lit("\u3000")).when(k % 4 == 1, F.lit("\nx")).otherwise(F.lit(""))
    t = p.select("p_partkey", F.concat(F.lit("\u3000"), wide, F.lit("\t"), tail).alias("raw"),
                 F.when(k % 5 == 0, F.lit("\u3000\t")).otherwise(F.col("p_name")).alias("key"))
    return quality.require_key(t, "key").select("p_partkey", fn.normalize_ws("raw").alias("text_ws"),
                                                fn.strip_newlines("raw").alias("text_nl"))


@check("union_reports", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, 'sales' AS data_source FROM lineitem
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_quantity AS return_qty, 'returns' AS data_source FROM lineitem WHERE l_returnflag = 'R'
""")
def union_reports(spark, d):
    """The line report and a returns report with a different column
    set, unioned by name with provenance."""
    li = table(spark, d, "lineitem")
    sales = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    returns = li.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("return_qty"))
    return reconcile.union_reports(sales, returns, labels=["sales", "returns"])


# Fixed test values: local (Chinese) export header names.
EXPORT_HEADERS = {"o_orderkey": "訂單編號", "o_custkey": "客戶編號", "o_orderstatus": "訂單狀態",
                  "o_totalprice": "訂單金額", "o_orderdate": "訂單日期"}


@check("monthly_export", """
SELECT CAST(o_orderkey AS VARCHAR) AS "訂單編號", CAST(o_custkey AS VARCHAR) AS "客戶編號",
       coalesce(o_orderstatus, '') AS "訂單狀態", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "訂單金額",
       strftime(o_orderdate, '%Y-%m-%d') AS "訂單日期", strftime(o_orderdate, '%Y-%m') AS year_month
FROM orders WHERE o_orderdate IS NOT NULL
""")
def monthly_export(spark, d):
    """K7 (frame) + D11: the month-partitioned export rows with local headers."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                                         "o_orderdate")
    return sinks.monthly_frame(o, "o_orderdate", EXPORT_HEADERS)


@check("monthly_files", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_sn, CAST(o_custkey AS VARCHAR) AS customer, coalesce(o_orderstatus, '') AS status,
       strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m') AS year_month, true AS sorted
FROM orders WHERE o_orderdate IS NOT NULL
""")
def monthly_files(spark, d):
    """K7: the monthly export written and read back; ``sorted`` tells that a row
    comes after the one before it in its file."""
    path = scratch_path(spark, f"months-{uuid.uuid4().hex}")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    sinks.monthly_export(o, "o_orderdate", path, rename=EXPORT_HEADERS, order=["o_orderdate", "o_orderkey"])
    back, _ = files.read_reports(spark, path, null_tokens=False)
    at = Window.partitionBy("source_path").orderBy("source_line")              # a file: one task's rows of a month
    key = F.struct(F.col("訂單日期"), F.lpad("訂單編號", 20, " "))
    before = F.lag(key).over(at)
    cell = lambda c: F.coalesce(F.col(c), F.lit(""))                                               # noqa: E731
    return back.select(F.col("訂單編號").alias("order_sn"), F.col("客戶編號").alias("customer"), cell("訂單狀態").alias("status"),
                       F.col("訂單日期").alias("day"), F.regexp_extract("source_path", "year_month=([0-9-]+)/", 1).alias("year_month"),
                       (before.isNull() | (before.getField("訂單日期") < F.col("訂單日期")) |
                        (before.getField("訂單日期") == F.col("訂單日期"))).alias("sorted"))


@check("csv_sink", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_sn, '備註 "' || o_orderpriority || '",' || chr(10) || o_orderstatus AS note,
       'UTF-8' AS source_encoding, (SELECT count(*) FROM orders) AS rows_loaded
FROM orders
""")
def csv_sink(spark, d):
    """K1: the CSV sink (byte-order mark, every cell quoted, line breaks inside),
    read back by the report reader."""
    path = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("訂單編號"),
        F.concat(F.lit('備註 "'), "o_orderpriority", F.lit('",\n'), "o_orderstatus").alias("備註"))
    loaded = sinks.write_table(o, path, fmt="csv", header="true", quoteAll="true", escape='"', multiLine="true", bom=True)
    back, _ = files.read_reports(spark, path)
    return back.select(F.col("訂單編號").alias("order_sn"), F.col("備註").alias("note"), "source_encoding",
                       F.lit(loaded.first()[0]).alias("rows_loaded"))


@check("header_validation", """
SELECT o_orderkey AS file, o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0 AS ok,
       concat_ws('|', CASE WHEN o_orderkey % 4 = 0 THEN 'order_sn' END, CASE WHEN o_orderkey % 3 = 0 THEN 'item_no' END) AS missing,
       'note_' || o_orderstatus AS extra
FROM orders
""")
def header_validation(spark, d):
    """The column names of one file per order against the registry."""
    k = F.col("o_orderkey")
    header = F.array_compact(F.array(F.when(k % 4 != 0, F.lit("order_sn")), F.concat(F.lit("note_"), "o_orderstatus"),
                                     F.when(k % 3 != 0, F.lit("item_no")), F.lit("price")))
    out = cf.validate_files(table(spark, d, "orders").select(k.alias("file"), header.alias("header")), LINE_REGISTRY)
    return out.select("file", "ok", F.array_join("missing", "|").alias("missing"), F.array_join("extra", "|").alias("extra"))


@check("profile_first_values", """
WITH f AS (SELECT *, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS r FROM orders),
t AS (SELECT * FROM f WHERE r <= 3),
v AS (SELECT 'o_orderkey' AS "column", 0 AS position, r, CAST(o_orderkey AS VARCHAR) AS value FROM t
      UNION ALL SELECT 'o_custkey', 1, r, CAST(o_custkey AS VARCHAR) FROM t
      UNION ALL SELECT 'o_orderstatus', 2, r, o_orderstatus FROM t
      UNION ALL SELECT 'o_orderpriority', 3, r, o_orderpriority FROM t)
SELECT "column", position, string_agg(coalesce(value, '-'), '|' ORDER BY r) AS first_values FROM v GROUP BY ALL
""")
def profile_first_values(spark, d):
    """The first three cells of every column, by the orders' date and key."""
    o = table(spark, d, "orders").withColumn("__day", F.col("o_orderdate"))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    out = quality.first_values(o.select(*cols, "__day"), ["__day", "o_orderkey"])
    return out.filter(F.col("column") != "__day").select(
        "column", "position", F.array_join("first_values", "|", "-").alias("first_values"))


@check("load_preview", """
WITH l AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS line_key FROM lineitem),
k AS (SELECT line_key, count(*) AS n FROM l GROUP BY 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM l) AS rows, (SELECT min(CAST(l_shipdate AS DATE)) FROM l) AS first_date,
       (SELECT max(CAST(l_shipdate AS DATE)) FROM l) AS last_date,
       (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM l) AS total_amount,
       (SELECT CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) FROM k) AS repeated_keys,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM k) AS surplus_rows
""")
def load_preview(spark, d):
    """K4: dry-run load summary of the line report."""
    li = table(spark, d, "lineitem").withColumn("line_key", F.concat_ws("_", "l_orderkey", "l_linenumber"))
    return sinks.load_preview(li, "l_shipdate", "l_extendedprice", "line_key")


@check("date_coverage", """
SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date,
       CAST(count(*) AS BIGINT) AS rows,
       'orders_' || strftime(min(o_orderdate), '%Y%m%d') || '_' || strftime(max(o_orderdate), '%Y%m%d') AS label
FROM orders GROUP BY 1
""")
def date_coverage(spark, d):
    """K9: per order priority the covered date range and its file label."""
    return sinks.date_coverage(table(spark, d, "orders"), "o_orderpriority", "o_orderdate", prefix="orders")


# ---------------------------------------------------------------- files / headers

@check("file_duplicates", """
WITH s AS (SELECT n_chars FROM documents GROUP BY n_chars HAVING count(*) > 1),
c AS (SELECT d.doc_id, d.n_chars, sha256(d.text) AS digest FROM documents d WHERE d.n_chars IN (SELECT n_chars FROM s)),
g AS (SELECT *, count(*) OVER (PARTITION BY n_chars, digest) AS group_size,
             row_number() OVER (PARTITION BY n_chars, digest ORDER BY doc_id) = 1 AS keep FROM c)
SELECT doc_id, n_chars, digest, CAST(group_size AS BIGINT) AS group_size, keep FROM g WHERE group_size > 1
""")
def file_duplicates(spark, d):
    """Documents treated as files — size groups first, then SHA-256 of the
    whole text inside repeated sizes; the first of each group is kept."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "text")
    r = files.duplicate_files(docs, size="n_chars", content="text", order="doc_id")
    return r.select("doc_id", "n_chars", "digest", F.col("group_size").cast("bigint").alias("group_size"), "keep")


@check("chunked_file_duplicates", """
SELECT o_orderpriority AS report, copy, CAST(2 AS BIGINT) AS group_size, copy = 'a' AS keep
FROM (SELECT DISTINCT o_orderpriority FROM orders), (VALUES ('a'), ('b')) AS v(copy)
""")
def chunked_file_duplicates(spark, d):
    """Orders exported as one text file per priority, twice (a, b) and once
    with a byte changed (c, of the same length); the identical files are found by
    digests of byte ranges that tasks read."""
    from orderlake.sources import digests
    o = table(spark, d, "orders")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_custkey").cast("string"))
    changed = F.col("o_orderkey") == F.min("o_orderkey").over(Window.partitionBy("o_orderpriority", "copy"))
    copies = o.withColumn("copy", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c")))).withColumn(
        "value", F.when((F.col("copy") == "c") & changed, F.translate(line, ",", ";")).otherwise(line))
    base = scratch_path(spark, f"digests-{uuid.uuid4().hex}")
    (copies.select("copy", F.col("o_orderpriority").alias("report"), "o_orderkey", "value")
     .repartition("copy", "report").sortWithinPartitions("copy", "report", "o_orderkey", "value")
     .select("copy", "report", "value").write.partitionBy("copy", "report").text(base))
    found = digests.duplicate_files_below(spark, base, glob="*.txt", chunk=1 << 16)
    name = lambda k: F.regexp_extract("path", f"/{k}=([^/]+)/", 1)                                 # noqa: E731
    return found.select(name("report").alias("report"), name("copy").alias("copy"), "group_size", "keep")


# Fixed test values: URL fields of crawled pages.
URL_PATTERNS = {
    "host": r"^https?://([^/?#]+)",
    "lang": r"^https?://[^/]+/([a-z][a-z])/",
    "doc_no": r"/([0-9]+)([?#]|$)",
    "page_no": r"[?&]page=([0-9]+)",
}


@check("file_metadata", """
SELECT page_id, url,
       nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host,
       nullif(regexp_extract(url, '^https?://[^/]+/([a-z][a-z])/', 1), '') AS lang,
       nullif(regexp_extract(url, '/([0-9]+)([?#]|$)', 1), '') AS doc_no,
       nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page_no,
       trim(regexp_replace(regexp_replace(url, '\\.[A-Za-z0-9]+$', ''), ' ?[(（][0-9]+[)）]$', '')) AS stem
FROM pages
""")
def file_metadata(spark, d):
    """Regex fields of page URLs (the "file names") and a canonical stem."""
    p = table(spark, d, "pages").select("page_id", "url")
    return files.file_metadata(p, name="url", patterns=URL_PATTERNS)


# Fixed test values: indicator words per report "type" (language).
REPORT_RULES = {
    "en": ["the", "and", "of", "is", "with", "for", "by", "that"],
    "fr": ["le", "la", "de", "des", "et", "en", "un", "du"],
    "de": ["der", "die", "und", "das", "ist", "von", "mit", "für"],
    "es": ["el", "la", "de", "que", "y", "en", "los", "por"],
}
REPORT_KEYWORDS = {"src0_": "priority_feed"}


def _rules_sql(first: bool) -> str:
    out = []
    for typ, ind in REPORT_RULES.items():
        arr = "[" + ", ".join(f"'{w}'" for w in ind) + "]"
        lst = "list_slice(header_list, 1, 8)" if first else "header_list"
        out.append(f"WHEN len(list_intersect({lst}, {arr})) >= 2 THEN '{typ}'")
    return " ".join(out)


@check("report_type", f"""
WITH h AS (SELECT doc_id, source || '_' || CAST(doc_id AS VARCHAR) || '.csv' AS file,
                  list_filter(string_split(lower(regexp_replace(split_part(text, chr(10), 1), '[.,;:!?]', '', 'g')), ' '), lambda x: x <> '') AS header_list
           FROM documents)
SELECT doc_id, file, CASE WHEN contains(file, 'src0_') THEN 'priority_feed' {_rules_sql(True)} {_rules_sql(False)} ELSE 'unknown' END AS report_type
FROM h
""")
def report_type(spark, d):
    """Classify each document ("file") by a file-name keyword, else by
    indicator words among its first-line "headers"."""
    docs = table(spark, d, "documents")
    first = F.substring_index(F.col("text"), "\n", 1)
    hl = F.filter(F.split(F.lower(F.regexp_replace(first, "[.,;:!?]", "")), " "), lambda x: x != "")
    h = docs.select("doc_id", F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("file"),
                    hl.alias("header_list"))
    r = headers.classify_reports(h, REPORT_RULES, REPORT_KEYWORDS, min_hits=2, first_n=8)
    return r.select("doc_id", "file", "report_type")


def _header_tables(spark, d):
    docs = table(spark, d, "documents")
    first = F.substring_index(F.col("text"), "\n", 1)
    toks = F.split(F.regexp_replace(first, "[.,;:!?]", ""), " ")
    h = docs.select(F.col("doc_id").alias("file"), F.posexplode(toks).alias("position", "header")) \
        .filter(F.col("header") != "").withColumn("position", F.col("position").cast("bigint"))
    bench = table(spark, d, "benchmark")
    words = bench.select(F.explode(F.split(F.regexp_replace("text", "[.,;:!?\n]", " "), " ")).alias("local_name")) \
        .filter(F.length("local_name") > 5).distinct()
    reg = sq.global_sequence(words, "local_name", out="reg_order").select(
        F.concat(F.lit("f_"), F.lower("local_name")).alias("name"), "local_name", "reg_order")
    return h, reg


HEADER_TABLES_SQL = """
h AS (SELECT doc_id AS file, CAST(pos - 1 AS BIGINT) AS position, header
      FROM (SELECT doc_id, unnest(string_split(regexp_replace(split_part(text, chr(10), 1), '[.,;:!?]', '', 'g'), ' ')) AS header,
                   unnest(generate_series(1, len(string_split(regexp_replace(split_part(text, chr(10), 1), '[.,;:!?]', '', 'g'), ' ')))) AS pos
            FROM documents) WHERE header <> ''),
w AS (SELECT DISTINCT local_name FROM (SELECT unnest(string_split(regexp_replace(text, '[.,;:!?\n]', ' ', 'g'), ' ')) AS local_name FROM benchmark)
      WHERE length(local_name) > 5),
r AS (SELECT 'f_' || lower(local_name) AS name, local_name, CAST(dense_rank() OVER (ORDER BY local_name) AS BIGINT) AS reg_order FROM w)
"""


def _contains_clean_sql(x):
    return f"trim(regexp_replace(translate(regexp_replace({x}, '[\\r\\n]', '', 'g'), '：（）', ':()'), {WS_SQL}, ' ', 'g'))"


@check("header_match_contains", f"""
WITH {HEADER_TABLES_SQL},
hc AS (SELECT *, {_contains_clean_sql('header')} AS c FROM h),
rc AS (SELECT *, {_contains_clean_sql('local_name')} AS c FROM r),
m AS (SELECT hc.file, hc.position, hc.header, rc.name, rc.reg_order,
             CASE WHEN hc.header = rc.local_name THEN 1 WHEN hc.c = rc.local_name THEN 2 ELSE 3 END AS stage
      FROM hc JOIN rc ON hc.header = rc.local_name OR hc.c = rc.c
                      OR (length(hc.c) > 5 AND length(rc.c) > 5
                          AND least(length(hc.c), length(rc.c)) / greatest(length(hc.c), length(rc.c)) > 0.7
                          AND (contains(hc.c, rc.c) OR contains(rc.c, hc.c))))
SELECT file, position, header, name, CAST(stage AS BIGINT) AS stage FROM (
  SELECT *, row_number() OVER (PARTITION BY file, position ORDER BY stage, reg_order) AS rn FROM m) WHERE rn = 1
""")
def header_match_contains(spark, d):
    """First-line tokens of every document ("headers") matched to a
    registry of long benchmark words by exact, cleaned or containment match."""
    h, reg = _header_tables(spark, d)
    return headers.match_contains(h, reg)


@check("header_match_fuzzy")
def header_match_fuzzy(spark, d):
    """The same headers matched by normalised equality, else difflib ratio
    above 0.85 on bigram-blocked candidate pairs (no SQL oracle: the ratio is
    difflib's)."""
    h, reg = _header_tables(spark, d)
    return headers.match_fuzzy(h, reg)


# ---------------------------------------------------------------- streaming / round trip

@check("stream_upsert", EVENTS_LATEST_SQL)
def stream_upsert(spark, d):
    """The events table replayed as a file stream (availableNow) and folded
    into a keyed target per micro-batch; result = the current target."""
    from orderlake.streaming import current_table, ingest_stream
    ev = table(spark, d, "events")
    run = uuid.uuid4().hex
    target = scratch_path(spark, f"stream-target-{run}")
    ckpt = scratch_path(spark, f"stream-ckpt-{run}")
    q = ingest_stream(spark, d.rstrip("/"), ev.schema, target, ckpt, keys=["user_id", "event_type"],
                      ts="ts", order=["event_id"], buckets=16, options={"pathGlobFilter": "events.parquet"})
    q.awaitTermination()
    return current_table(spark, target).select(*ev.columns)


@check("stream_restart", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def stream_restart(spark, d):
    """R1 + K6: a stream that is started again with a new checkpoint in the
    middle.  The even events come first and are compacted, the odd ones by the
    new query, whose batches count from 0 again; the newest arrival wins, and no
    key of the first half is lost.  A replayed batch and the table's earlier
    version are left as they were."""
    from orderlake.sources import versions
    from orderlake.streaming import compact_epochs, current_table, ingest_stream, upsert_batch
    ev = table(spark, d, "events")
    run = uuid.uuid4().hex
    base, target = scratch_path(spark, f"halves-{run}"), scratch_path(spark, f"restart-target-{run}")
    for half in (0, 1):
        ev.filter(F.pmod("event_id", F.lit(2)) == half).write.parquet(f"{base}/{half}")
        ingest_stream(spark, f"{base}/{half}", ev.schema, target, f"{base}/checkpoint-{half}",
                      keys=["user_id", "event_type"], order=["event_id"], buckets=16).awaitTermination()
        if half == 0:
            upsert_batch(ev, 0, target, ["user_id", "event_type"], order=["event_id"], buckets=16,
                         writer=next(iter(versions.manifest(spark, target)["writers"])))          # a replay: nothing
            compact_epochs(spark, target)
    return current_table(spark, target).select("event_id", "ts", "user_id", "event_type", "value")


@check("versioned_upsert", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS round FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, -1 FROM orders WHERE o_orderkey % 2 = 0
""")
def versioned_upsert(spark, d):
    """K6: half of the orders loaded, then an upsert of the rest and of changed
    ones swapped in as one version.  Round -1 is the first version, read back
    after the swap."""
    from orderlake.sources import versions
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = scratch_path(spark, f"versioned-{uuid.uuid4().hex}")
    first = versions.replace_table(o.filter("o_orderkey % 2 = 0").withColumn("round", F.lit(0)), target)
    old = versions.read_table(spark, target)
    new = o.filter("o_orderkey % 2 <> 0 OR o_orderkey % 3 = 0").withColumn(
        "round", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0)).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "new").otherwise(F.col("o_orderstatus")))
    versions.replace_table(up.upsert(old, new, ["o_orderkey"]), target, seen=first)
    before = versions.read_table(spark, target, first["version"]).withColumn("round", F.lit(-1))
    return versions.read_table(spark, target).unionByName(before)


@check("csv_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'UTF-8' ELSE 'Big5' END AS source_encoding
FROM orders
""")
def csv_roundtrip(spark, d):
    """K1 + S1/S2/S6: orders exported as CSV in two encodings, read back as an
    all-text table grouped by encoding, with provenance."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
        (F.col("o_orderkey").cast("bigint") % 2).alias("__half"))
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    paths = {}
    for half, enc in ((0, "UTF-8"), (1, "Big5")):
        p = f"{base}/{enc}"
        o.filter(F.col("__half") == half).drop("__half").write.option("header", "true") \
            .option("encoding", enc).csv(p)
        paths[enc] = [p]
    r = files.read_orders(spark, paths)
    return r.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                    "source_encoding")


MIXED_NOTE_SQL = "'訂單' || CAST(o_orderkey AS VARCHAR) || ', \"' || o_orderpriority || '\"，備註'"
MIXED_SHELF_SQL = "'上午' || chr(10) || '上' || CAST(o_custkey AS VARCHAR)"


@check("mixed_reports", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_sn, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS status,
       {MIXED_NOTE_SQL} AS note, CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey AS VARCHAR) END AS customer,
       CASE WHEN o_orderkey % 3 > 0 THEN {MIXED_SHELF_SQL} END AS shelf,
       CASE o_orderkey % 3 WHEN 0 THEN 'UTF-8' WHEN 1 THEN 'x-windows-950' ELSE 'UTF-16' END AS source_encoding,
       true AS has_line
FROM orders
""")
def mixed_reports(spark, d):
    """S1 + S5 + S6 + U1: orders exported as CSV files in three encodings, each
    with another column order and other columns, found and read back: encodings
    detected, rows united by the names in each file's own header.  A header and
    its cells hold line breaks, and characters whose UTF-16 bytes do."""
    key = F.col("o_orderkey")
    o = table(spark, d, "orders").select(
        (key % 3).alias("__kind"), key.cast("string").alias("訂單編號"), F.col("o_orderstatus").alias("狀態"),
        F.concat(F.lit("訂單"), key.cast("string"), F.lit(', "'), "o_orderpriority", F.lit('"，備註')).alias("備註"),
        F.concat(F.lit("上午\n上"), F.col("o_custkey").cast("string")).alias("上\n架"),
        F.col("o_custkey").cast("string").alias("客戶"))
    base = scratch_path(spark, f"mixed-{uuid.uuid4().hex}")
    kinds = [("UTF-8", ["訂單編號", "狀態", "備註"]), ("Big5", ["備註", "上\n架", "訂單編號", "狀態"]),
             ("UTF-16", ["客戶", "上\n架", "備註", "訂單編號"])]
    for k, (enc, cols) in enumerate(kinds):
        o.filter(F.col("__kind") == k).select(*cols).write.option("header", "true").option("encoding", enc).option(
            "escape", '"').csv(f"{base}/{enc}")
    rows, _ = files.read_reports(spark, base)
    return rows.select(F.col("訂單編號").alias("order_sn"), F.col("狀態").alias("status"), F.col("備註").alias("note"),
                       F.col("客戶").alias("customer"), F.col("上\n架").alias("shelf"), "source_encoding",
                       (F.col("source_line") > 0).alias("has_line"))


@check("messy_reports", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS id_1, 'f' || CAST(o_custkey AS VARCHAR) AS file_1,
       o_orderpriority || chr(10) || '"q", ' || CAST(o_orderkey AS VARCHAR) AS note,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || ',f' || CAST(o_custkey AS VARCHAR)
            || ',"' || o_orderpriority || chr(10) || '""q"", ' || CAST(o_orderkey AS VARCHAR) || '",surplus' END AS bad_record,
       row_number() OVER (ORDER BY o_orderkey, o_custkey) AS line
FROM orders
""")
def messy_reports(spark, d):
    """S1/S2 in splits: all orders as one CSV file whose records all span two
    lines, with names that differ in case only or are reserved; a fifth of the
    records have a cell more than the header.  Read by as many tasks as the file
    has splits; ``line`` is the record's place in the file."""
    key = F.col("o_orderkey").cast("string")
    note = F.concat("o_orderpriority", F.lit('\n""q"", '), key)
    line = F.concat_ws(",", key, "o_orderstatus", F.concat(F.lit("f"), F.col("o_custkey").cast("string")),
                       F.concat(F.lit('"'), note, F.lit('"')), F.when(F.col("o_orderkey") % 5 == 0, F.lit("surplus")))
    path = scratch_path(spark, f"messy-{uuid.uuid4().hex}")
    head = spark.createDataFrame([(-1, 0, 'ID,id,source_file,"備\n註"')], "a long, b long, value string")
    body = table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("a"),
                                            F.col("o_custkey").cast("long").alias("b"), line.alias("value"))
    # the export is one file on purpose: it is what splits have to cut.  It is sorted in
    # parts, which the writing task takes one after another and needn't hold
    head.unionByName(body).orderBy("a", "b").select("value").checkpoint(eager=True).coalesce(1).write.text(path)
    rows, _ = files.read_reports(spark, path)
    return rows.select(F.col("ID").alias("id"), F.col("`id.1`").alias("id_1"), F.col("`source_file.1`").alias("file_1"),
                       F.col("備\n註").alias("note"), F.col(files.CORRUPT).alias("bad_record"),
                       F.col("source_line").alias("line"))


# ---------------------------------------------------------------- ordering / suppression

@check("prefixed_id_order", """
WITH t AS (SELECT o_orderkey,
                  CASE WHEN o_orderkey % 17 = 0 THEN 'RMX' || CAST(o_orderkey AS VARCHAR)
                       WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN NULL
                       WHEN o_orderkey % 29 = 0 THEN CAST(o_orderkey AS VARCHAR)
                       WHEN o_orderkey % 31 = 0 THEN 'RM00' || repeat(CAST(o_orderkey AS VARCHAR), 5)
                       ELSE 'RM' || CAST(o_orderkey AS VARCHAR) END AS sn FROM orders),
k AS (SELECT o_orderkey, sn,
             CASE WHEN regexp_matches(sn, '^RM[0-9]+$') THEN regexp_replace(substr(sn, 3), '^0+([0-9])', '\\1')
                  ELSE '0' END AS sort_key,
             coalesce(sn, '') = '' AS invalid FROM t)
SELECT o_orderkey, sn, sort_key, invalid,
       CAST(row_number() OVER (ORDER BY invalid ASC, length(sort_key) ASC, sort_key ASC, sn ASC NULLS FIRST, o_orderkey ASC) AS BIGINT) AS position
FROM k
""")
def prefixed_id_order(spark, d):
    """O2 + F4: prefixed order ids of any length sorted by their number, blank
    ids last, ids without the prefix as 0; the position is materialised with the
    distributed global sequence."""
    from orderlake.operators import ordering as od
    o = table(spark, d, "orders").select("o_orderkey")
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    sn = (F.when(key % 17 == 0, F.concat(F.lit("RMX"), text)).when(key % 19 == 0, F.lit(""))
          .when(key % 23 == 0, F.lit(None).cast("string")).when(key % 29 == 0, text)
          .when(key % 31 == 0, F.concat(F.lit("RM00"), F.repeat(text, F.lit(5))))
          .otherwise(F.concat(F.lit("RM"), text)))
    size, digits = od.prefixed_id_order("sn", "RM")
    k = o.select("o_orderkey", sn.alias("sn")).select(
        "o_orderkey", "sn", digits.alias("sort_key"), (~od.filled("sn")).alias("invalid"), size.alias("__size"))
    order = ["invalid", "__size", "sort_key", "sn", "o_orderkey"]
    return sq.global_sequence(k, order, out="position").drop("__size")


@check("stream_suppress_duplicates", """
SELECT DISTINCT user_id, event_type FROM events
""")
def stream_suppress_duplicates(spark, d):
    """R2: the events file replayed as a stream with duplicate suppression per
    (user, event type) inside a 30-day event-time horizon; which duplicate
    survives is arbitrary by design, so only the keys are reported."""
    from orderlake.streaming import suppress_duplicates
    ev = table(spark, d, "events")
    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(d.rstrip("/"))
    name = f"suppressed_{uuid.uuid4().hex}"
    q = (suppress_duplicates(stream, ["user_id", "event_type"], "ts", "30 days").writeStream
         .format("parquet").option("path", scratch_path(spark, name))
         .option("checkpointLocation", scratch_path(spark, name + "-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(scratch_path(spark, name)).select("user_id", "event_type")


@check("stream_survivors", """
WITH RECURSIVE e AS (SELECT event_id, ts, user_id, event_type, value FROM events),
p AS (SELECT user_id, event_type, min(ts) AS start FROM e GROUP BY ALL
      UNION ALL
      SELECT p.user_id, p.event_type, (SELECT min(ts) FROM e WHERE e.user_id = p.user_id AND e.event_type = p.event_type
                                       AND e.ts >= p.start + INTERVAL 3 DAY) AS next
      FROM p WHERE next IS NOT NULL),
w AS (SELECT e.*, row_number() OVER (PARTITION BY e.user_id, e.event_type, p.start ORDER BY e.ts DESC, e.event_id DESC) AS rn, p.start
      FROM e JOIN p ON e.user_id = p.user_id AND e.event_type = p.event_type AND e.ts >= p.start AND e.ts < p.start + INTERVAL 3 DAY)
SELECT event_id, ts, user_id, event_type, value FROM w
WHERE rn = 1 AND start + INTERVAL 3 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM e)
""")
def stream_survivors(spark, d):
    """R2: the last row of every (user, event type) and period of three days, a
    horizon far shorter than the events; the stream comes in three micro-batches,
    the last with rows that are too late.  Periods that the watermark hasn't
    passed at the end are still open and not reported."""
    from orderlake.streaming.survivors import rocksdb, survivors
    ev = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    base = scratch_path(spark, f"survivors-{uuid.uuid4().hex}")
    lo, hi = ev.agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    third = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - lo) * 3 / (hi - lo + 1)), F.lit(2))
    late = ev.withColumn("ts", (F.col("ts") - F.expr("INTERVAL 1000 DAYS")).cast(ev.schema["ts"].dataType)).withColumn(
        "value", F.lit(None).cast(ev.schema["value"].dataType))
    for k in range(3):
        part = ev.filter(third == k)
        (part.unionByName(late) if k == 2 else part).write.mode("append").parquet(f"{base}/in")
        # the files that are new to the checkpoint are one micro-batch
        stream = spark.readStream.schema(ev.schema).parquet(f"{base}/in")
        out = survivors(stream, ["user_id", "event_type"], "ts", "event_id", "3 days", "1 hour")
        with rocksdb(spark):
            (out.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(ev.schema).parquet(f"{base}/out")


@check("product_refs", """
WITH t AS (SELECT p_partkey,
                  CASE WHEN p_partkey % 4 = 0 THEN p_name
                       WHEN p_partkey % 4 = 1 THEN p_name || ' (' || upper(replace(p_brand, '#', '')) || '-' || CAST(p_size AS VARCHAR) || ')'
                       WHEN p_partkey % 4 = 2 THEN p_name || ' (' || upper(replace(p_type, ' ', '_')) || '-X' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size % 10 AS VARCHAR) || ')'
                       ELSE p_name || ' (' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size * 100 AS VARCHAR) || ')' END AS product_name
           FROM part)
SELECT p_partkey, product_name,
       CASE WHEN regexp_matches(product_name, '\\(([A-Za-z0-9_-]+)-([0-9]{1,3})\\)$')
            THEN regexp_extract(product_name, '\\(([A-Za-z0-9_-]+)-([0-9]{1,3})\\)$', 1) END AS ref_id,
       CASE WHEN regexp_matches(product_name, '\\(([A-Za-z0-9_-]+)-([0-9]{1,3})\\)$')
            THEN lpad(regexp_extract(product_name, '\\(([A-Za-z0-9_-]+)-([0-9]{1,3})\\)$', 2), 3, '0') END AS ref_option
FROM t
""")
def product_refs(spark, d):
    """Product id and zero-padded option parsed from a trailing
    ``(ID-nn)`` in product names (names without one, or with a 4-digit option,
    give NULLs)."""
    p = table(spark, d, "part")
    k = F.col("p_partkey") % 4
    name = (F.when(k == 0, F.col("p_name"))
            .when(k == 1, F.concat(F.col("p_name"), F.lit(" ("), F.upper(F.regexp_replace("p_brand", "#", "")),
                                   F.lit("-"), F.col("p_size").cast("string"), F.lit(")")))
            .when(k == 2, F.concat(F.col("p_name"), F.lit(" ("), F.upper(F.regexp_replace("p_type", " ", "_")),
                                   F.lit("-X"), F.col("p_partkey").cast("string"), F.lit("-"),
                                   (F.col("p_size") % 10).cast("string"), F.lit(")")))
            .otherwise(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_partkey").cast("string"), F.lit("-"),
                                (F.col("p_size") * 100).cast("string"), F.lit(")"))))
    t = p.select("p_partkey", name.alias("product_name"))
    ref = fn.product_ref_from_name("product_name")
    return t.select("p_partkey", "product_name", ref.ref_id.alias("ref_id"), ref.ref_option.alias("ref_option"))


# ---------------------------------------------------------------- banner TSV (S3)

#: Rows of an exported file, which one task writes; reading is in splits of any size.
TSV_ROWS = 1_000_000


def _report_files(rows, col):
    """(report, pieces): files of each report, by its row count."""
    return rows.groupBy(F.col(col).alias("report")).agg(
        F.ceil(F.count(F.lit(1)) / TSV_ROWS).cast("int").alias("pieces"))


def _with_piece(data, counts):
    return (data.join(F.broadcast(counts), data["report"].eqNullSafe(counts["report"])).drop(counts["report"])
            .withColumn("piece", F.pmod(F.xxhash64("c0"), F.col("pieces")).cast("int")).drop("pieces"))


BANNER_TSV_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@check("banner_tsv_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority AS report
FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def banner_tsv_roundtrip(spark, d):
    """S3: orders exported as UTF-16 tab-separated reports, one per priority,
    with a banner line before the header (the 5-LOW report lacks the banner
    and must be skipped), then read back by banner and header position."""
    from orderlake.plans.marketplace import BANNER_C
    o = table(spark, d, "orders")
    cols = BANNER_TSV_COLUMNS
    data = o.select(F.col("o_orderpriority").alias("report"), F.lit(2).alias("__ord"),
                    F.col("o_orderkey").cast("string").alias("c0"), F.col("o_custkey").cast("string").alias("c1"),
                    F.col("o_orderstatus").alias("c2"),
                    F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("c3"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("c4"))
    counts = _report_files(o, "o_orderpriority")
    data = _with_piece(data, counts)
    reports = counts.select("report", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    head = reports.select("report", F.lit(1).alias("__ord"), *[F.lit(c).alias(f"c{i}") for i, c in enumerate(cols)], "piece")
    banner = reports.filter(F.col("report") != "5-LOW").select(
        "report", F.lit(0).alias("__ord"), F.lit(BANNER_C + "僅供參考】").alias("c0"),
        *[F.lit("").alias(f"c{i}") for i in range(1, len(cols))], "piece")
    rows = banner.unionByName(head).unionByName(data)
    path = scratch_path(spark, f"banner-{uuid.uuid4().hex}")
    (rows.repartition("report", "piece").sortWithinPartitions("report", "piece", "__ord", "c0").drop("__ord")
     .write.partitionBy("report", "piece").option("sep", "\t").option("encoding", "UTF-16").option("header", "false")
     .option("emptyValue", "").csv(path))
    long = files.read_banner_tsv(spark, path, banner=BANNER_C, encoding="UTF-16")
    wide = files.pivot_banner_rows(long, cols)
    # the report name is the partition folder of the file
    report = F.expr("url_decode(regexp_extract(source_path, 'report=([^/]+)/', 1))")
    return wide.select(*cols, report.alias("report"))


# Fixed test values: return-report headers (two carry the required keywords).
RETURN_TSV_HEADERS = ["訂單編號", "退貨申請日", "審核通過日", "訂單狀態"]


@check("return_tsv_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS "訂單編號", strftime(o_orderdate, '%Y-%m-%d') AS "退貨申請日",
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS "審核通過日", o_orderstatus AS "訂單狀態"
FROM orders WHERE o_orderstatus <> 'O'
""")
def return_tsv_roundtrip(spark, d):
    """UTF-16 TSV reports with the header on the first line; a report is
    kept only if its headers contain both the return-request and the approval
    keyword (the 'O' status report uses other headers and is skipped)."""
    from orderlake.plans.marketplace import RETURN_HEADERS_C
    o = table(spark, d, "orders")
    data = o.select(F.col("o_orderstatus").alias("report"), F.lit(1).alias("__ord"),
                    F.col("o_orderkey").cast("string").alias("c0"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("c1"),
                    F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM-dd").alias("c2"),
                    F.col("o_orderstatus").alias("c3"))
    counts = _report_files(o, "o_orderstatus")
    data = _with_piece(data, counts)
    reports = counts.select("report", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    plain = ["訂單編號", "建立日", "更新日", "訂單狀態"]            # no return keywords
    head = reports.select("report", F.lit(0).alias("__ord"), *[
        F.when(F.col("report") == "O", F.lit(p)).otherwise(F.lit(h)).alias(f"c{i}")
        for i, (h, p) in enumerate(zip(RETURN_TSV_HEADERS, plain))], "piece")
    path = scratch_path(spark, f"returns-{uuid.uuid4().hex}")
    (head.unionByName(data).repartition("report", "piece").sortWithinPartitions("report", "piece", "__ord", "c0").drop("__ord")
     .write.partitionBy("report", "piece").option("sep", "\t").option("encoding", "UTF-16").option("header", "false")
     .csv(path))
    long = files.read_banner_tsv(spark, path, header_line=1, encoding="UTF-16", require_headers=RETURN_HEADERS_C)
    return files.pivot_banner_rows(long, RETURN_TSV_HEADERS).select(*RETURN_TSV_HEADERS)


# ---------------------------------------------------------------- loads, files, columns, sorts

@check("load_dispositions", """
SELECT year(o_orderdate) * 100 + month(o_orderdate) AS month, count(*) AS rows, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
FROM orders GROUP BY 1
""")
def load_dispositions(spark, d):
    """K2 + K3 + K5 + K8: orders loaded into a month-partitioned typed table;
    loading them again as an append finds repeated keys and becomes a truncate,
    so the table still holds each order once."""
    fields = [cf.Field("order_sn", 1), cf.Field("amount", 2, type="NUMERIC"), cf.Field("month", 3, type="INTEGER")]
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_sn"), F.col("o_totalprice").alias("amount"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"))
    path, schema = scratch_path(spark, f"load-{uuid.uuid4().hex}"), cf.schema_for(fields)
    sinks.write_table(o, path, "truncate", schema=schema, partition_by=["month"], sort_within=["order_sn"])
    old = spark.read.schema(schema).parquet(path).checkpoint(eager=True)
    mode = sinks.guarded_mode(old.unionByName(o.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])),
                              "order_sn", "append", on_dup="overwrite")
    sinks.write_table(o, path, mode, schema=schema, partition_by=["month"])
    back = spark.read.schema(schema).parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


@check("latest_files", """
WITH f AS (SELECT url AS path, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS name, regexp_extract(url, '://([^/?#]*)', 1) AS stem,
                  (page_id * 7919) % 1009 AS m FROM pages)
SELECT path, name, stem, 'snapshot' AS kind FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY m DESC, path DESC) AS k FROM f) WHERE k = 1
UNION ALL
SELECT path, name, canonical, 'newest' FROM (SELECT *, regexp_replace(name, '[0-9]', '', 'g') AS canonical,
       row_number() OVER (PARTITION BY regexp_replace(name, '[0-9]', '', 'g') ORDER BY m DESC, path DESC) AS k FROM f) WHERE k = 1
""")
def latest_files(spark, d):
    """S7 + S11: every page as a file of its host: the newest file per host, and
    the newest per canonical name."""
    url = F.col("url")
    f = table(spark, d, "pages").select(
        url.alias("path"), F.regexp_extract(url, r"([^/?#]*)([?#].*)?$", 1).alias("name"),
        F.timestamp_seconds((F.col("page_id") * 7919) % 1009).alias("modificationTime"))
    snap = files.latest_snapshot(f, F.regexp_extract("path", "://([^/?#]*)", 1))
    newest = files.newest_version(f, F.regexp_replace("name", "[0-9]", ""))
    return snap.select("path", "name", "stem", F.lit("snapshot").alias("kind")).unionByName(
        newest.select("path", "name", F.col("canonical_name").alias("stem"), F.lit("newest").alias("kind")))


@check("master_dimension", """
WITH t AS (SELECT p_brand AS shop_id, p_partkey, p_name AS shop_name FROM part WHERE p_partkey % 10 <> 0)
SELECT shop_id, shop_name FROM (SELECT *, row_number() OVER (PARTITION BY shop_id ORDER BY p_partkey DESC) AS k FROM t) WHERE k = 1
""")
def master_dimension(spark, d):
    """The parts as JSON master entries (every tenth without a key), loaded
    as a dimension: blank keys dropped, the last entry of a key wins."""
    from orderlake.sources import master
    p = table(spark, d, "part")
    entries = p.select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).otherwise(F.lit(" ")).alias("shop_id"),
                       F.col("p_name").alias("shop_name"))
    path = scratch_path(spark, f"master-{uuid.uuid4().hex}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries.repartitionByRange(n, "p_partkey").sortWithinPartitions("p_partkey").write.json(path)
    return master.load_dimension(spark, path, "shop_id", position="p_partkey").select("shop_id", "shop_name")


@check("master_yaml", """
WITH t AS (SELECT p_brand AS code, p_partkey, p_name AS name, p_type AS kind, CAST(p_size AS VARCHAR) AS size,
                  p_name || chr(10) || '  ' || p_type AS label FROM part
           WHERE p_partkey % 10 <> 0 AND p_partkey % 7 <> 0)
SELECT code, name, kind, size, label, '' AS missing
FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY p_partkey DESC) AS k FROM t) WHERE k = 1
""")
def master_yaml(spark, d):
    """The parts as YAML masters (codes plain or quoted, every tenth without a
    code, every seventh without attributes), read by small byte ranges into one
    dimension: blank codes dropped, the last entry of a code wins."""
    from orderlake.sources import master
    code, name = F.col("p_brand"), F.col("p_name")
    quoted = F.concat(F.lit("'"), F.replace(code, F.lit("'"), F.lit("''")), F.lit("'"))
    key = (F.when(F.col("p_partkey") % 20 == 0, "~").when(F.col("p_partkey") % 10 == 0, "''")
           .when(F.col("p_partkey") % 3 == 0, F.to_json(F.array(code)).substr(F.lit(2), F.length(F.to_json(F.array(code))) - 2))
           .otherwise(quoted))
    lines = F.array(F.concat(key, F.lit(":   # a part")), F.concat(F.lit("  name: '"), F.replace(name, F.lit("'"), F.lit("''")), F.lit("'")),
                    F.concat(F.lit("  more: {kind: '"), F.replace("p_type", F.lit("'"), F.lit("''")), F.lit("'}")),
                    F.concat(F.lit("  size: "), F.col("p_size")), F.lit(""), F.lit("  label: |-"),
                    F.concat(F.lit("    "), name), F.concat(F.lit("      "), F.col("p_type")))
    text = F.when(F.col("p_partkey") % 7 == 0, F.concat(key, F.lit(": {}"))).otherwise(F.array_join(lines, "\n"))
    path = scratch_path(spark, f"master-yaml-{uuid.uuid4().hex}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (table(spark, d, "part").repartitionByRange(n, "p_partkey").sortWithinPartitions("p_partkey")
     .select(text.alias("value")).write.text(path))
    return master.load_yaml_dimension(spark, path, "code", ["name", "more.kind", "size", "label", "missing"],
                                      split_bytes=16 << 10).withColumnRenamed("more.kind", "kind")


@check("messy_columns", """
SELECT p_partkey AS col_1st_key, p_name AS name中, p_size AS a_b, CAST(p_retailprice AS DECIMAL(18,2)) AS a_b_1, p_brand AS product_brand, p_brand AS brand_alt FROM part
""")
def messy_columns(spark, d):
    """P8 + P9 + P10: names with brackets, dots, digits and a collision made
    safe and unique; an absent column filled from the first that holds the
    keyword; listed columns first."""
    p = table(spark, d, "part").select("p_name", "p_partkey", "p_size", F.col("p_retailprice").cast("decimal(18,2)"), "p_brand")
    p = p.toDF(*cf.sanitize_names(["Name【中】", "1st key", "a-b", "a.b", "Brand alt"]))
    p = cf.fallback_column(p, "product_brand", "brand")
    return p.select(*cf.order_columns(p.columns, first=["col_1st_key"], prefixes=["name", "a_"], last=["brand_alt"]))


@check("sorted_positions", """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 5 = 0 THEN CAST(9007199254740992 + o_orderkey AS VARCHAR)
                  ELSE CAST(o_orderkey AS VARCHAR) || CASE o_orderkey % 2 WHEN 0 THEN '.0' ELSE '' END END AS sn, o_custkey FROM orders)
SELECT o_orderkey, sn, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 9007199254740992 + o_orderkey
                                                        ELSE o_orderkey END ASC NULLS LAST, o_orderkey ASC) AS numeric_place,
       row_number() OVER (ORDER BY o_custkey ASC NULLS LAST, sn ASC NULLS LAST, o_orderkey ASC) AS keyed_place FROM t
""")
def sorted_positions(spark, d):
    """O1 + O3: places of all orders by the numeric value of their text ids (some
    beyond what doubles tell apart) and by several keys, taken from the sorted
    rows themselves."""
    from orderlake.operators import ordering as od
    k = F.col("o_orderkey")
    sn = F.when(k % 13 == 0, F.lit("n/a")).when(k % 5 == 0, (k + 9007199254740992).cast("string")).otherwise(
        F.concat(k.cast("string"), F.when(k % 2 == 0, F.lit(".0")).otherwise(F.lit(""))))
    t = table(spark, d, "orders").select("o_orderkey", "o_custkey", sn.alias("sn"))

    def placed(df, name):          # the rows' order in the sorted frame, as a number
        return sq.global_sequence(df.withColumn("__at", F.monotonically_increasing_id()), "__at", out=name)
    a = placed(od.sort_numeric(t, "sn", "o_orderkey"), "numeric_place").select("o_orderkey", "sn", "numeric_place")
    b = placed(od.sort_by(t, "o_custkey", "sn", "o_orderkey"), "keyed_place").select("o_orderkey", "keyed_place")
    return a.join(b, "o_orderkey")


@check("largest_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority ASC NULLS LAST, o_orderkey ASC LIMIT 200
""")
def largest_orders(spark, d):
    """The first 200 orders of a total order (the limit is the operator)."""
    from orderlake.operators import ordering as od
    return od.head(table(spark, d, "orders"), 200, "o_orderpriority", "o_orderkey").select("o_orderkey", "o_totalprice")


@check("distinct_customers", "SELECT DISTINCT o_custkey FROM orders")
def distinct_customers(spark, d):
    """The distinct values of a column."""
    return quality.distinct_values(table(spark, d, "orders"), "o_custkey")


@check("split_date_times", f"""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 3 THEN 'soon' WHEN o_orderkey % 7 = 4 THEN ' '
                  WHEN o_orderkey % 7 = 5 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:20:30' ELSE {_rendered_sql()} END AS cell,
                  o_orderkey % 7 = 5 AS iso, o_orderdate FROM orders),
x AS (SELECT o_orderkey, CASE WHEN iso THEN CAST(o_orderdate AS DATE) + INTERVAL 37230 SECOND ELSE {_multi_ts_sql('cell')} END AS moment FROM s)
SELECT o_orderkey, CAST(moment AS DATE) AS day, strftime(moment, '%H:%M:%S') AS time, 
       CASE WHEN o_orderkey % 7 = 5 OR o_orderkey % 9 < 6 THEN strftime(moment, '%Y-%m-%d') ELSE '' END AS day_text FROM x WHERE moment IS NOT NULL
""")
def split_date_times(spark, d):
    """D4 + F5: date-time cells (ISO ones too) split into a date and a time; rows
    whose date doesn't parse are dropped.  D12's text knows the layouts with the
    year first."""
    k = F.col("o_orderkey")
    cell = F.when(k % 7 == 3, F.lit("soon")).when(k % 7 == 4, F.lit(" ")).when(
        k % 7 == 5, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:20:30"))).otherwise(_rendered())
    s = table(spark, d, "orders").select("o_orderkey", cell.alias("cell")).withColumn("x", fn.split_datetime("cell"))
    return quality.require_date(s, "cell", F.col("x.date")).select(
        "o_orderkey", F.col("x.date").alias("day"), F.col("x.time").alias("time"), fn.date_from_timestamp("cell").alias("day_text"))
