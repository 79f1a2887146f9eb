"""Every constant of the model against values typed in here from its definition.

The loan has no term at zero: each coefficient, centre and bound takes part in some
check, so a mistyped one in the library cannot pass (its oracle shares the constants).
"""

import math

import numpy as np
import pytest

from creditspark.operators import backtest, capital, risk, staging, stress

LOAN = dict(loan_id=1, age=58.0, annual_income=41000.0, loan_amount=73000.0, credit_score=612.0, dti_ratio=0.37,
            utilization_ratio=0.64, num_inquiries_12m=3, employment_years=11.0, vintage_index=4,
            booking_unemp=6.3, booking_gdp_growth=1.7, booking_hpi=117.0, term_months=48)


def frame(spark, **more):
    row = {**LOAN, **more}
    return spark.createDataFrame([tuple(row.values())], list(row))


def logistic(z):
    return 1 / (1 + math.exp(-min(max(z, -10), 10)))


def test_pit_pd(spark):
    z = (-4.0 + 0.02 * (58 - 45) - 5e-6 * 41000 + 8e-5 * 73000 - 0.007 * 612 + 7.0 * 0.37 + 3.0 * 0.64 + 0.25 * 3
         - 0.03 * 11 + 0.35 * 4.4 - 0.10 * 2.6 + 0.15 * 4)
    got = risk.pit_pd(frame(spark), {"unemployment_rate": 4.4, "gdp_growth": 2.6}).first().pd_12m
    assert -9 < z < 9 and got == pytest.approx(logistic(z), rel=1e-12)
    shocked = stress.shock_macro(spark.createDataFrame([(4.4, 2.6)], "unemployment_rate double, gdp_growth double")).first()
    assert (shocked.unemployment_rate_stressed, shocked.gdp_growth_stressed) == pytest.approx((7.4, -1.4))
    df = frame(spark, ead=10.0, lgd=0.5)
    s = stress.stress_additive(df, {"unemployment_rate": 7.4, "gdp_growth": -1.4}).first()
    assert s.pd_12m_stressed == pytest.approx(logistic(z + 0.35 * 3 + 0.10 * 4), rel=1e-12)
    assert s.ecl_12m_stressed == pytest.approx(5 * s.pd_12m_stressed, rel=1e-12)


def test_origination_and_current_pd(spark):
    z = (-4.0 + 0.02 * (58 - 45) - 5e-6 * 41000 + 5e-5 * 73000 - 0.006 * 612 + 5.0 * 0.37 + 2.0 * 0.64 + 0.20 * 3
         - 0.02 * 11 + 0.10 * 4)
    df = risk.origination_pd(frame(spark, pd_mult=1.3))
    assert df.first().pd_12m_origination == pytest.approx(logistic(z), rel=1e-12)
    assert risk.current_pd(df).first().pd_12m == pytest.approx(min(max(logistic(z) * 1.3, 0.0001), 0.99), rel=1e-12)
    for mult, want in ((1e-9, 0.0001), (1e9, 0.99)):
        assert risk.current_pd(risk.origination_pd(frame(spark, pd_mult=mult))).first().pd_12m == want


def test_lgd_and_ecl(spark):
    lgd = 0.15 + 0.0009 * (850 - 612) + 0.01 * (6.3 - 5) - 0.00005 * (117 - 100)
    df = risk.lgd_from_score(frame(spark, ead=1000.0, pd_12m=0.2, default_12m=1))
    assert df.first().lgd == pytest.approx(lgd, rel=1e-12)
    r = risk.ecl_term(df).first()
    life = 0.2 * (1 + (48 / 12 - 1) * 0.6)
    assert (r.realized_loss_12m, r.ecl_12m, r.pd_lifetime, r.ecl_lifetime) == pytest.approx(
        (1000 * lgd, 200 * lgd, life, 1000 * lgd * life), rel=1e-12)
    for score, want in ((-400.0, 0.95), (1000.0, 0.05)):
        assert risk.lgd_from_score(frame(spark).drop("credit_score").selectExpr("*", f"{score}D AS credit_score")).first().lgd == want
    top = risk.ecl_term(risk.lgd_from_score(frame(spark, ead=1.0, pd_12m=0.9, default_12m=0))).first()
    assert top.pd_lifetime == 0.999


@pytest.mark.parametrize("pd, flags", [(0.25, (0, 0)), (0.26, (1, 0)), (0.40, (1, 0)), (0.41, (1, 1))])
def test_dpd(spark, pd, flags):
    df = frame(spark, pd_12m=pd, pd_12m_origination=0.1, default_12m=0)
    r = risk.pd_ratio_and_flags(df).first()
    assert (r.dpd_30_plus, r.dpd_90_plus) == flags and r.pd_ratio == pytest.approx(pd / 0.1)


def test_bands_grades_and_sicr(spark):
    stages = {0.0199: 1, 0.02: 2, 0.0999: 2, 0.10: 3}
    for pd, stage in stages.items():
        assert staging.stage_by_pd_band(frame(spark, pd_12m=pd)).first().stage == stage
    grades = {0.0049: ("A", 0.20), 0.005: ("BBB", 0.50), 0.019: ("BBB", 0.50), 0.02: ("BB", 0.75), 0.049: ("BB", 0.75),
              0.05: ("B", 1.00), 0.149: ("B", 1.00), 0.15: ("CCC", 1.50)}
    for pd, (grade, weight) in grades.items():
        r = capital.basel_standardised(frame(spark, pd_12m=pd, ead=200.0)).first()
        assert (r.basel_grade, r.basel_rw, r.rwa_standardised, r.capital_required_std) == (
            grade, weight, pytest.approx(200 * weight), pytest.approx(16 * weight))
    base = dict(default_12m=0, dpd_30_plus=0, dpd_90_plus=0)
    for ratio, pd, stage in ((1.49, 0.099, 1), (1.5, 0.01, 2), (1.0, 0.10, 2)):
        assert staging.sicr_stage(frame(spark, pd_ratio=ratio, pd_12m=pd, **base)).first().stage_ifrs9 == stage


def test_multiplicative_stress():
    assert stress.pd_multiplier({"unemployment_rate": 0.11, "gdp_growth": -0.02}) == pytest.approx(1 + 3 * 0.06 + 8 * 0.02)


def test_terms_of_both_sections(spark):
    from creditspark.sources.loan_tape import with_draws
    loans = spark.range(4000).selectExpr("id AS loan_id", "12 AS term_months")
    got = with_draws(loans, "A").groupBy("term_months").count().collect()
    assert {r.term_months: round(r["count"] / 4000, 1) for r in got} == {24: 0.2, 36: 0.3, 48: 0.3, 60: 0.2}
    assert with_draws(loans, "B").select("term_months").distinct().count() == 1


# ---- the back-test -------------------------------------------------------------------------

def make(spark, n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 2.0, 0.5]
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.4 + x @ [1.0, -0.6, 0.3])))).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "loan_id long, default_12m int, a double, b double, c double"), x, y


def newton(x, y):
    """The optimum of summed log-loss + |w|^2 / 2, by Newton's method on the dense Hessian."""
    z = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (p - y) + ridge @ w)
    return w


def test_fit_is_the_optimum_and_scores_follow(spark):
    df, x, y = make(spark)
    model = backtest.fit_pd_model(df, ("a", "b", "c"))
    want = newton(x, y)
    assert [model.intercept, *model.coefficients.toArray()] == pytest.approx(want.tolist(), abs=1e-6)
    assert model.summary.totalIterations < backtest.MAX_ITER
    got = {r.loan_id: r.pd_model for r in backtest.score(model, df, ("a", "b", "c")).collect()}
    p = 1 / (1 + np.exp(-(model.intercept + x @ model.coefficients.toArray())))
    assert [got[i] for i in range(len(x))] == pytest.approx(p.tolist(), rel=1e-9)


@pytest.mark.parametrize("bad", ["null", "nan"])
def test_bad_features_fail(spark, bad):
    df, _, _ = make(spark, 60)
    wrong = df.selectExpr("loan_id", "default_12m", f"CASE WHEN loan_id = 5 THEN {'NULL' if bad == 'null' else 'double(chr(78)||chr(97)||chr(78))'} ELSE a END AS a", "b", "c")
    with pytest.raises(Exception, match="(?i)null|nan"):
        backtest.fit_pd_model(wrong, ("a", "b", "c"))
    model = backtest.fit_pd_model(df, ("a", "b", "c"))
    with pytest.raises(Exception, match="(?i)null|nan"):
        backtest.score(model, wrong, ("a", "b", "c")).collect()


def test_split_is_exact_and_ignores_the_label(spark):
    df, _, y = make(spark, 701)
    got = {r.loan_id: r.split for r in backtest.stratified_split(df).collect()}
    sizes = [sum(got[i] == "test" and y[i] == c for i in got) for c in (0, 1)]
    assert sum(sizes) == math.ceil(0.3 * 701)
    assert all(abs(s - 0.3 * (y == c).sum()) < 1 for c, s in zip((0, 1), sizes))
    key = {r.loan_id: r.k for r in df.select("loan_id", backtest.split_key().alias("k")).collect()}
    for c in (0, 1):  # the test rows are those of the smallest keys, and keys know nothing of labels
        mine = sorted((i for i in got if y[i] == c), key=key.get)
        assert {got[i] for i in mine[: sizes[c]]} == {"test"} and {got[i] for i in mine[sizes[c]:]} == {"train"}
    with pytest.raises(ValueError, match="default_12m"):
        backtest.stratified_split(df.selectExpr("loan_id", "nullif(default_12m, 1) AS default_12m"))


def test_champion_score(spark):
    z = (0.5 + 0.015 * 58 - 4e-6 * 41000 - 0.006 * 612 - 0.02 * 11 + 5.0 * 0.37 + 2.5 * 0.64 + 0.2 * 3 + 0.1 * 6.3
         - 0.05 * 1.7 + 0.12 * 4)
    assert backtest.champion_score(frame(spark)).first().pd_model == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-12)
