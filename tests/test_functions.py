"""Anchors (FIXTURES §4), NULL/NaN rules and keyed draws."""

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from creditspark.functions import (Term, clip, linear_score, norm_cdf, norm_ppf, sigmoid, uniform,
                                   with_norm_cdf, with_norm_ppf)
from creditspark.operators import risk, stress
from creditspark.operators.capital import basel_irb

L0 = dict(age=45.0, annual_income=60000.0, loan_amount=20000.0, credit_score=700.0, dti_ratio=0.3,
          utilization_ratio=0.5, num_inquiries_12m=2, employment_years=5.0)


def one(spark, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols.keys()))


def test_pit_pd_anchor(spark):
    df = one(spark, **L0, vintage_index=2)
    got = risk.pit_pd(df, {"unemployment_rate": 5.0, "gdp_growth": 3.0}).first()["pd_12m"]
    assert got == pytest.approx(0.13010847436299783, rel=1e-9)


def test_pit_pd_additive_stress_anchor(spark):
    df = one(spark, **L0, vintage_index=2, ead=1.0, lgd=1.0)
    got = stress.stress_additive(df, {"unemployment_rate": 8.0, "gdp_growth": -1.0}).first()["pd_12m_stressed"]
    assert got == pytest.approx(0.389360766050778, rel=1e-9)


def test_origination_pd_anchor(spark):
    df = one(spark, **L0, vintage_index=0.5)
    got = risk.origination_pd(df).first()["pd_12m_origination"]
    assert got == pytest.approx(0.009471043581946115, rel=1e-9)


def test_sigmoid_clamp(spark):
    r = spark.range(1).select(sigmoid(F.lit(-99.0)).alias("lo"), sigmoid(F.lit(99.0)).alias("hi")).first()
    assert r["lo"] == pytest.approx(4.5397868702434395e-05, rel=1e-12)
    assert r["hi"] == pytest.approx(0.9999546021312976, rel=1e-12)


def test_lgd_anchor(spark):
    df = one(spark, credit_score=700.0, booking_unemp=6.0, booking_hpi=110.0)
    assert risk.lgd_from_score(df).first()["lgd"] == pytest.approx(0.2945, rel=1e-9)


@pytest.mark.parametrize("term,mult", [(12, 1.0), (24, 1.6), (36, 2.2), (48, 2.8), (60, 3.4)])
def test_lifetime_multiplier(spark, term, mult):
    df = one(spark, ead=1.0, lgd=1.0, pd_12m=0.1, default_12m=0, term_months=term)
    assert risk.ecl_term(df).first()["pd_lifetime"] == pytest.approx(0.1 * mult, rel=1e-12)


def test_stress_multiplier_is_1_45():
    assert stress.pd_multiplier({"unemployment_rate": 0.12, "gdp_growth": -0.03}) == pytest.approx(1.45, rel=1e-12)


def test_clip_keeps_null_and_nan_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (2.0,), (0.5,)], "x double")
    got = [r[0] for r in df.select(clip("x", 0.0, 1.0)).collect()]
    assert got[0] is None and got[1] is None
    assert got[2:] == [0.0, 1.0, 0.5]


def test_linear_score_literal_terms(spark):
    df = one(spark, a=2.0)
    z = linear_score(1.0, [Term(2.0, "a", 1.0), Term(3.0, "m")], {"m": 10.0})
    assert df.select(z).first()[0] == pytest.approx(1.0 + 2.0 * 1.0 + 30.0)


def test_norm_ppf_matches_stdlib(spark):
    ps = [1e-12, 1e-6, 1e-4, 0.001, 0.02, 0.075, 0.3, 0.5, 0.7, 0.925, 0.98, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    plain = [r[0] for r in df.select(norm_ppf("p")).collect()]
    staged = [r["z"] for r in with_norm_ppf(df, "p", "z").collect()]
    for p, a, b in zip(ps, plain, staged):
        want = NormalDist().inv_cdf(p)
        assert a == pytest.approx(want, rel=1e-13, abs=1e-13)
        assert b == pytest.approx(want, rel=1e-13, abs=1e-13)


def test_norm_ppf_invalid_is_null(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,), (float("nan"),)], "p double")
    assert [r["z"] for r in with_norm_ppf(df, "p", "z").collect()] == [None] * 4


def test_norm_cdf_matches_erfc(spark):
    xs = [-40.0, -8.0, -6.0, -3.72, -1.0, -1e-3, 0.0, 0.5, 3.09, 7.5, 38.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    plain = [r[0] for r in df.select(norm_cdf("x")).collect()]
    staged = [r["c"] for r in with_norm_cdf(df, "x", "c").collect()]
    for x, a, b in zip(xs, plain, staged):
        want = 0.5 * math.erfc(-x / math.sqrt(2))
        assert a == pytest.approx(want, rel=1e-13, abs=1e-15)
        assert b == pytest.approx(want, rel=1e-13, abs=1e-15)


def test_cdf_of_ppf_round_trip(spark):
    df = spark.range(1, 1000).select((F.col("id") / 1000.0).alias("p"))
    out = with_norm_cdf(with_norm_ppf(df, "p", "z"), "z", "c")
    worst = out.select(F.max(F.abs(F.col("c") - F.col("p")))).first()[0]
    assert worst < 1e-14


IRB = [  # pd, lgd, M, K, rwa, capital (ead 1000)
    (0.01, 0.45, 2.5, 0.1320887027, 1651.108784, 132.0887027),
    (0.01, 0.45, 1.0, 0.05862270531, 732.7838163, 58.62270531),
    (0.01, 0.45, 5.0, 0.2545320316, 3181.650395, 254.5320316),
    (0.0, 0.45, 1.0, 0.002516917485, 31.46146856, 2.516917485),
    (0.0, 0.45, 5.0, 0.09842180768, 1230.272596, 98.42180768),
    (0.05, 0.0, 2.0, 0.003495319578, 43.69149473, 3.495319578),
    (0.2, 0.99, 3.0, 0.6021693591, 7527.116989, 602.1693591),
    (1.0, 0.45, 5.0, 0.0007063477691, 8.829347114, 0.7063477691),
]


def test_irb_anchors(spark):
    df = spark.createDataFrame([(i, pd, lgd, 1000.0, m) for i, (pd, lgd, m, *_r) in enumerate(IRB)],
                               "i int, pd_12m double, lgd double, ead double, effective_maturity_years double")
    got = {r["i"]: r for r in basel_irb(df).collect()}
    for i, (_pd, _lgd, _m, k, rwa, cap) in enumerate(IRB):
        assert got[i]["irb_cap_ratio_per_ead"] == pytest.approx(k, rel=1e-8)
        assert got[i]["rwa_irb"] == pytest.approx(rwa, rel=1e-8)
        assert got[i]["capital_required_irb"] == pytest.approx(cap, rel=1e-8)


def test_irb_null_inputs_stay_null(spark):
    df = spark.createDataFrame([(None, 0.4, 1000.0, 2.5), (0.01, None, 1000.0, 2.5)],
                               "pd_12m double, lgd double, ead double, effective_maturity_years double")
    assert [r["irb_cap_ratio_per_ead"] for r in basel_irb(df).collect()] == [None, None]


def test_irb_maturity_from_term(spark):
    df = spark.createDataFrame([(0.01, 0.45, 1000.0, 30)], "pd_12m double, lgd double, ead double, term_months int")
    r = basel_irb(df).first()
    assert r["effective_maturity_years"] == pytest.approx(2.5)
    assert r["irb_cap_ratio_per_ead"] == pytest.approx(0.1320887027, rel=1e-8)


def test_draws_ignore_partitioning(spark):
    base = spark.range(0, 2000)
    a = base.repartition(1).select("id", uniform("id", 3).alias("u")).collect()
    b = base.repartition(16).select("id", uniform("id", 3).alias("u")).collect()
    assert dict((r.id, r.u) for r in a) == dict((r.id, r.u) for r in b)


def test_draws_uniform_and_independent(spark):
    df = spark.range(0, 20000).select(uniform("id", 1).alias("a"), uniform("id", 2).alias("b"),
                                      uniform("id", 5).alias("c"))
    r = df.agg(F.avg("a"), F.min("a"), F.max("a"), F.corr("a", "b"), F.corr("a", "c")).first()
    assert abs(r[0] - 0.5) < 0.01 and r[1] >= 0.0 and r[2] < 1.0
    assert abs(r[3]) < 0.03 and abs(r[4]) < 0.03


def test_filter_after_irb_is_planned(spark):
    df = spark.createDataFrame([(0.01 * i, 0.45, 1000.0, 2.5) for i in range(1, 50)],
                               "pd_12m double, lgd double, ead double, effective_maturity_years double")
    irb = basel_irb(df)
    want = sum(1 for r in irb.collect() if r["capital_required_irb"] > 150 and r["irb_cap_ratio_per_ead"] < 0.2)
    assert 0 < want < 49
    assert irb.where("capital_required_irb > 150 AND irb_cap_ratio_per_ead < 0.2").count() == want
    out2 = with_norm_cdf(with_norm_ppf(df, "pd_12m", "z"), "z", "c").where("c > 0.205 AND z < 1")
    assert out2.count() == df.where("pd_12m > 0.205 AND pd_12m < 0.8413447460685429").count()


def test_sql_functions_match_dataframe_helpers(spark):
    from creditspark.functions.sqlfunctions import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql("SELECT cs_sigmoid(99.0D) s, cs_norm_cdf(1.0D) c, cs_norm_ppf(0.975D) q, "
                  "cs_clip(CAST('NaN' AS DOUBLE), 0D, 1D) n, cs_clip(5.0D, 0D, 1D) k").first()
    assert r["s"] == pytest.approx(0.9999546021312976, rel=1e-12)
    assert r["c"] == pytest.approx(0.5 * math.erfc(-1 / math.sqrt(2)), rel=1e-13)
    assert r["q"] == pytest.approx(NormalDist().inv_cdf(0.975), rel=1e-13)
    assert r["n"] is None and r["k"] == 1.0
    df = spark.range(0, 50).selectExpr("id", "cs_uniform(id, 6) AS a")
    df = df.select("id", "a", uniform("id", 6).alias("b"))
    assert df.where("a <> b").count() == 0


def test_shock_macro_adds_columns(spark):
    import datetime as dt

    from creditspark.sources.macro import macro_series
    m = stress.shock_macro(macro_series(spark, dt.date(2015, 1, 1), 3)).first()
    assert m["unemployment_rate_stressed"] == pytest.approx(m["unemployment_rate"] + 3.0)
    assert m["gdp_growth_stressed"] == pytest.approx(m["gdp_growth"] - 4.0)


def test_lgd_noise_is_keyed_normal(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("loan_id"), F.lit(700.0).alias("credit_score"),
                                      F.lit(6.0).alias("booking_unemp"), F.lit(110.0).alias("booking_hpi"))
    a = risk.lgd_from_score(df, noise_sd=0.05)
    b = risk.lgd_from_score(df.repartition(7), noise_sd=0.05)
    r = a.agg(F.avg("lgd"), F.stddev("lgd")).first()
    assert r[0] == pytest.approx(0.2945, abs=0.002) and r[1] == pytest.approx(0.05, rel=0.05)
    assert a.exceptAll(b).count() == 0
