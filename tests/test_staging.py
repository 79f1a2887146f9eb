"""Boundary truth tables (FIXTURES §3)."""

import pytest

from creditspark.operators import capital, reports, risk, staging


def test_pd_bands(spark):
    df = spark.createDataFrame([(0.0199999,), (0.02,), (0.0999999,), (0.10,), (None,)], "pd_12m double")
    assert [r["stage"] for r in staging.stage_by_pd_band(df).collect()] == [1, 2, 2, 3, 0]


def test_dpd_flags(spark):
    rows = [(0, 0.25, 0.1), (0, 0.2500001, 0.1), (0, 0.40, 0.1), (0, 0.4000001, 0.1), (1, 0.01, 0.01)]
    df = spark.createDataFrame(rows, "default_12m int, pd_12m double, pd_12m_origination double")
    got = [(r["dpd_30_plus"], r["dpd_90_plus"]) for r in risk.pd_ratio_and_flags(df).collect()]
    assert got == [(0, 0), (1, 0), (1, 0), (1, 1), (1, 1)]


def test_pd_ratio_zero_origination(spark):
    df = spark.createDataFrame([(0, 0.01, 0.0)], "default_12m int, pd_12m double, pd_12m_origination double")
    assert risk.pd_ratio_and_flags(df).first()["pd_ratio"] == pytest.approx(10000.0)


SICR = [
    # ratio, pd, default, dpd30, dpd90, params, expected
    (1.5, 0.01, 0, 0, 0, {}, 2),
    (1.0, 0.10, 0, 0, 0, {}, 2),
    (1.4999, 0.0999, 0, 0, 0, {}, 1),
    (1.0, 0.01, 1, 0, 0, {}, 3),
    (1.0, 0.01, 0, 0, 1, {}, 3),
    (1.0, 0.5, 0, 1, 1, {"default_90dpd": False}, 2),
    (1.0, 0.30, 0, 1, 0, {"abs_pd_threshold": 0.5}, 2),
    (1.0, 0.30, 0, 1, 0, {"abs_pd_threshold": 0.5, "backstop_30dpd": False}, 1),
    (None, None, 0, 0, 0, {}, 1),
]


@pytest.mark.parametrize("ratio,pd,d,d30,d90,params,want", SICR)
def test_sicr(spark, ratio, pd, d, d30, d90, params, want):
    df = spark.createDataFrame([(ratio, pd, d, d30, d90)],
                               "pd_ratio double, pd_12m double, default_12m int, dpd_30_plus int, dpd_90_plus int")
    assert staging.sicr_stage(df, **params).first()["stage_ifrs9"] == want


def test_restage_keeps_stage3_and_flags(spark):
    rows = [(0.01, 0.01, 1, 1, 1), (0.01, 0.01, 0, 0, 0), (0.08, 0.05, 0, 0, 0)]
    df = spark.createDataFrame(rows, "pd_12m double, pd_12m_origination double, default_12m int, "
                                     "dpd_30_plus int, dpd_90_plus int")
    df = df.withColumn("pd_12m_stressed", df["pd_12m"] * 1.45)
    got = [r["stage_ifrs9_stressed"] for r in staging.restage_stressed(df).collect()]
    assert got == [3, 1, 2]


def test_grades_and_weights(spark):
    pds = [0.0049999, 0.005, 0.02, 0.05, 0.15, None]
    df = spark.createDataFrame([(p, 100.0) for p in pds], "pd_12m double, ead double")
    rows = capital.basel_standardised(df).collect()
    assert [r["basel_grade"] for r in rows] == ["A", "BBB", "BB", "B", "CCC", "CCC"]
    assert [r["basel_rw"] for r in rows] == [0.20, 0.50, 0.75, 1.00, 1.50, 1.50]
    assert [r["capital_required_std"] for r in rows] == pytest.approx([1.6, 4.0, 6.0, 8.0, 12.0, 12.0])


def test_band_join_equals_rule_chain(spark):
    pds = [0.0, 0.0049999, 0.005, 0.0199, 0.02, 0.049, 0.05, 0.1499, 0.15, 0.99, None]
    df = spark.createDataFrame([(i, p, 10.0) for i, p in enumerate(pds)], "i int, pd_12m double, ead double")
    a = {r["i"]: (r["basel_grade"], r["basel_rw"]) for r in capital.basel_standardised(df).collect()}
    b = {r["i"]: (r["basel_grade"], r["basel_rw"])
         for r in capital.basel_standardised_by_bands(df, capital.grade_bands(spark)).collect()}
    assert a == b


def test_band_join_blocks_gaps_and_nulls(spark):
    from creditspark.operators.joins import band_join
    bands = spark.createDataFrame([(f"b{i}", float(3 * i), float(3 * i + 2)) for i in range(25)] + [("low", None, -5.0)],
                                  "name string, lo double, hi double")
    values = [None, float("nan"), -9.0, -5.0, -1.0, 0.0, 1.99, 2.0, 3.0, 40.5, 73.9, 74.0, 1e9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    want = [None, None, "low", None, None, "b0", "b0", None, "b1", "b13", "b24", None, None]
    for block in (4, 10_000):
        got = band_join(df, bands, "v", block=block)
        assert [r.name for r in got.orderBy("i").collect()] == want and got.count() == len(values)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="overlap"):
        band_join(df, spark.createDataFrame([("a", 0.0, 2.0), ("b", 1.0, 3.0)], bands.schema), "v")


def test_allowance_rule(spark):
    rows = [(1, 1, 10.0, 0.1, 0.1, 1.0, 3.0), (2, 2, 10.0, 0.1, 0.1, 1.0, 3.0), (3, 3, 10.0, 0.1, 0.1, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "loan_id int, stage_ifrs9 int, ead double, pd_12m double, lgd double, "
                                     "ecl_12m double, ecl_lifetime double")
    got = {r["stage_ifrs9"]: r["reported_loss_allowance"] for r in reports.stage_ecl(df).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 3.0}
    assert reports.total_allowance(df).first()[0] == pytest.approx(7.0)
