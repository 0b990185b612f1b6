"""Plan-level guards for the scale properties (see PLANS.md)."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E

SF = os.environ.get("ORDERLAKE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}


def plan_of(spark, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF).explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(spark, n) for n in QUERIES}


def test_no_cartesian_nested_loop_or_row_python(plans):
    for name, p in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in p, (name, bad)


def test_dedupe_limits_before_the_shuffle(plans):
    for name in ("dedupe_keep_last", "dedupe_keep_first", "dedupe_source_priority", "dedupe_latest"):
        p = plans[name]
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_flagship_has_no_full_outer_join_and_pruned_scans(plans):
    p = plans["order_reconcile"]
    assert "FullOuter" not in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string>" in p


def test_numbering_uses_no_group_window(plans):
    """Windows run inside range partitions (__pid) or over one row per partition."""
    for name in ("line_sequence", "consecutive_runs", "upsert_orders", "prefixed_id_order"):
        specs = set(re.findall(r"windowspecdefinition\((\w+)#", plans[name]))
        assert specs and specs <= {"__pid", "__part"}, (name, specs)
        assert "MapInPandas" not in plans[name], name


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plans["priority_union"] or \
        "EqualTo(o_orderstatus,F)" in plans["priority_union"]
