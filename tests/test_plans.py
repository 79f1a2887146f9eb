"""Physical-plan guards for scale: pruning, pushdown, bounded broadcasts, no all-pairs joins."""

import re

import pytest

import __spark_entry__ as E


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for sides too large to broadcast
    try:
        qs = E.queries()
        yield {n: plan_text(qs[n](spark, sf_small)) for n in
               ("stage_ecl", "portfolio_kpis", "irb_by_stage", "stage_ecl_stressed", "final_table",
                "basel_grade_band_join")}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_orders_scan_is_pruned(plans):
    for name, text in plans.items():
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
        order_scans = [s for s in schemas if "o_orderkey" in s]
        assert order_scans, name
        for s in order_scans:
            cols = {c.split(":")[0] for c in s.split(",")}
            assert cols <= {"o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"}, (name, cols)


def test_no_all_pairs_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_band_join_is_a_hash_join_on_the_interval(plans):
    text = plans["basel_grade_band_join"]
    assert "BroadcastHashJoin" in text and "BuildRight" in text


def test_the_customer_side_is_broadcast_by_measured_size_only(plans):
    for name, text in plans.items():
        assert "SortMergeJoin [o_custkey" in text and "LeftOuter" in text, name


def test_macro_lookup_is_a_broadcast_hash_join(plans):
    text = plans["portfolio_kpis"]
    assert text.count("BroadcastHashJoin") == 1  # the bounded macro table
    assert "LeftOuter" in text


def test_one_aggregation_exchange_for_stage_tables(plans):
    for name in ("stage_ecl", "stage_ecl_stressed", "irb_by_stage"):
        text = plans[name]
        assert "partial_" in text, name                      # map-side partial aggregation
        assert "rangepartitioning" not in text, name         # bounded summaries sorted locally
        assert len(re.findall(r"Exchange hashpartitioning\(stage_ifrs9", text)) <= 1, name


def test_only_window_is_the_bounded_macro_path(plans):
    for name, text in plans.items():
        n_windows = len(re.findall(r"^\s*[:+\- ]*Window \[", text, flags=re.M))
        if name in ("portfolio_kpis", "final_table"):  # part A uses the macro path
            assert n_windows == 1, name        # running HPI product over the month calendar
            tail = text[text.index("Window ["):]
            assert "Range (0," in tail, name   # ... whose input is the bounded month range
        else:
            assert n_windows == 0, (name, n_windows)


def _max_method_bytes(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        seq = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = []
        it = seq.iterator()
        while it.hasNext():
            sizes.append(it.next()._3().maxMethodCodeSize())
        return max(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", ["irb_capital", "irb_by_stage", "stage_ecl", "loan_tape"])
def test_generated_methods_fit_the_jit_limit(spark, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    assert _max_method_bytes(spark, df) < 8000
