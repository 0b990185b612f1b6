"""Every registered check against its independent SQL (DuckDB) at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = os.environ.get("ORDERLAKE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}     # those have tests of their own
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_check_has_oracle_or_is_documented():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"header_match_fuzzy"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_check_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert len(srows) == len(orows)
    cols = sorted(sdf.columns)
    hs, ls = digest(srows, cols)
    ho, lo = digest(orows, cols)
    assert hs == ho, (sorted(set(ls) - set(lo))[:3], sorted(set(lo) - set(ls))[:3])


def test_fuzzy_headers_superset_of_exact(spark):
    df = QUERIES["header_match_fuzzy"](spark, SF)
    assert df.filter("score <= 0.85").count() == 0
    assert df.groupBy("file", "name").count().filter("count > 1").count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "line_uid" in df.columns


def test_fuzzy_headers_equal_brute_force(spark):
    """P3's prefix-filtered candidates lose no match: per file and registry field,
    the rule in plain Python over all headers of the file."""
    import re
    import unicodedata
    from difflib import SequenceMatcher

    from orderlake.operators import headers as H

    def norm(text):
        text = unicodedata.normalize("NFKC", re.sub(r"[（(【\[].*?[)）】\]]", "", text))
        return re.sub(r"[\s\-_/]", "", text).lower()

    fields = ["訂單編號", "收件人姓名", "商品名稱(中)", "abcdefghijklmnopqrst", "㎏①ｱ", "Ship-To Name", "abcdefghijklmnopqrsu", "z"]
    files_ = {"a": ["訂單編號 ", "收件人 姓名", "商品名稱【x】", "abcdefghijklmnopqrsx", "kg1ア", "ship_to/name", "abcdefghijklmnopqrsy"],
              "b": ["訂單－編號", "訂單編號(1)", "收件人姓名稱", "bacdefghijklmnopqrst", "SHIPTONAMES", "", "z", "Z", "abcdefghijklmnopqrst"],
              "c": ["aabcdefghijklmnopqrst", "abcdefghijklmnopqrstt", "ship to nam", "商品名称"]}
    rows = [(f, i, h) for f, hs in files_.items() for i, h in enumerate(hs)]
    reg = spark.createDataFrame([(f"f{i}", t, i) for i, t in enumerate(fields)], "name string, local_name string, reg_order int")
    got = {(r["file"], r["name"]): (r["position"], r["header"], r["how"]) for r in
           H.match_fuzzy(spark.createDataFrame(rows, "file string, position int, header string"), reg).collect()}
    want = {}
    for f, hs in files_.items():
        by_norm = {norm(h): (i, h) for i, h in enumerate(hs)}
        for k, t in enumerate(fields):
            n = norm(t)
            if n in by_norm:
                want[f, f"f{k}"] = (*by_norm[n], "exact")
                continue
            top = 0
            for m, at in by_norm.items():
                ratio = SequenceMatcher(None, n, m).ratio()
                if ratio > top:
                    top, hit = ratio, at
            if top > 0.85:
                want[f, f"f{k}"] = (*hit, "fuzzy")
    assert got == want


def test_fuzzy_query_equals_brute_force_on_whole_headers(spark):
    """The registered query against difflib on every (file, field) that some
    header of the file could reach by length and letters."""
    from collections import defaultdict
    from difflib import SequenceMatcher

    from orderlake.operators import headers as H
    from orderlake.plans import checks
    h, reg = checks._header_tables(spark, SF)
    got = {(r["file"], r["name"]): (r["position"], r["how"]) for r in H.match_fuzzy(h, reg).collect()}
    texts = {r["header"]: r["n"] for r in h.select("header").distinct().withColumn("n", H.normalize_fuzzy("header")).collect()}
    fields = {r["name"]: r["n"] for r in reg.withColumn("n", H.normalize_fuzzy("local_name")).collect()}
    by_text = defaultdict(dict)
    for r in h.orderBy("file", "position").collect():
        by_text[r["file"]][texts[r["header"]]] = r["position"]
    ratios = {}
    for n in set(texts.values()):
        m = SequenceMatcher(None, "", n)
        for name, t in fields.items():
            m.set_seq1(t)
            if t != n and m.real_quick_ratio() > 0.85 and m.quick_ratio() > 0.85 and (x := m.ratio()) > 0.85:
                ratios[name, n] = x
    want = {}
    for f, at in by_text.items():
        for name, t in fields.items():
            if t in at:
                want[f, name] = (at[t], "exact")
                continue
            best = max(((ratios[name, n], -k, p) for k, (n, p) in enumerate(at.items()) if (name, n) in ratios), default=None)
            if best:
                want[f, name] = (best[2], "fuzzy")
    assert got == want


def test_one_file_is_written_without_sorting_in_one_task(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    plans, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: plans.append(
        self._df._jdf.queryExecution().executedPlan().toString()) or text(self, *a, **k))
    assert QUERIES["messy_reports"](spark, SF).count() > 0
    assert len(plans) == 1 and "Sort" not in plans[0], plans
