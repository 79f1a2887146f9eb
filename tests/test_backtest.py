"""K1, K2 — radix selection of the split and the Newton fit, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_anchors import make, newton

from creditspark.operators import backtest


def test_newton_steps_reach_the_optimum(spark):
    df, x, y = make(spark)
    model = backtest.fit_logistic(df, ("a", "b", "c"))
    want = newton(x, y)
    assert [model.intercept, *model.weights] == pytest.approx(want.tolist(), abs=1e-6)
    z = want[0] + x @ want[1:]
    loss = (np.log1p(np.exp(z)) - y * z).sum() + 0.5 * (want[1:] ** 2).sum()
    assert model.log_loss == pytest.approx(loss, rel=1e-9) and model.steps < backtest.NEWTON_STEPS
    got = {r.loan_id: r.pd_model for r in backtest.logistic_score(df, model).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx((1 / (1 + np.exp(-z))).tolist(), rel=1e-6)


def test_one_step_is_one_aggregate_of_gradient_and_hessian(spark):
    df, x, y = make(spark)
    w = np.array([0.3, -0.2, 0.1, 0.05])
    rows = df.selectExpr("double(default_12m) AS y", "a", "b", "c")
    loss, gradient, hessian = backtest.newton_sums(rows, ("a", "b", "c"), "y", w)
    full = np.column_stack([np.ones(len(x)), x])
    p = 1 / (1 + np.exp(-full @ w))
    assert gradient == pytest.approx(full.T @ (p - y), rel=1e-9, abs=1e-6)
    assert hessian == pytest.approx(full.T @ (full * (p * (1 - p))[:, None]), rel=1e-9, abs=1e-6)
    assert loss == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum(), rel=1e-9)


def test_the_units_do_not_change_the_fit(spark, monkeypatch):
    df, _, _ = make(spark)
    plain = backtest.fit_logistic(df, ("a", "b", "c"))
    monkeypatch.setattr(backtest, "UNITS", {"a": 1000.0, "c": 0.01})
    assert backtest.fit_logistic(df, ("a", "b", "c")).weights == pytest.approx(plain.weights, rel=1e-7)


def test_ml_model_agrees(spark):
    df, _, _ = make(spark)
    model, other = backtest.fit_logistic(df, ("a", "b", "c")), backtest.fit_pd_model(df, ("a", "b", "c"))
    assert [model.intercept, *model.weights] == pytest.approx([other.intercept, *other.coefficients.toArray()], abs=1e-5)


@pytest.mark.parametrize("bad", ["cast(NULL AS double)", "double('NaN')"])
@pytest.mark.parametrize("column", ["a", "default_12m"])
def test_null_or_nan_is_an_error(spark, bad, column):
    df, _, _ = make(spark, 60)
    wrong = df.withColumn(column, F.expr(f"CASE WHEN loan_id = 5 THEN {bad} ELSE double({column}) END"))
    with pytest.raises(Exception, match=f"{column} is NULL or NaN"):
        backtest.fit_logistic(wrong, ("a", "b", "c"))
    if column == "a":
        with pytest.raises(Exception, match="a is NULL or NaN"):
            backtest.logistic_score(wrong, backtest.fit_logistic(df, ("a", "b", "c"))).collect()


def test_separable_classes_and_no_rows(spark):
    df = spark.range(200).selectExpr("id AS loan_id", "int(id >= 100) AS default_12m", "double(id) AS a")
    model = backtest.fit_logistic(df, ("a",), steps=40)
    z = np.arange(200.0)
    want = newton(z[:, None], (z >= 100).astype(float))
    assert model.weights[0] > 0 and np.isfinite(want).all()
    assert [model.intercept, *model.weights] == pytest.approx(want.tolist(), rel=1e-4)
    with pytest.raises(ValueError, match="no rows"):
        backtest.fit_logistic(df.where("false"), ("a",))


def radix(df, wanted, **kw):
    return backtest.smallest_keys(df, F.col("k"), "c", wanted, **kw)


@pytest.mark.parametrize(("bits", "fetched"), [(12, 10_000), (12, 0), (5, 3), (52, 0)])
def test_cuts_are_exact(spark, bits, fetched):
    rng = np.random.default_rng(5)
    rows = [(int(c), int(k)) for c in (0, 1, 7) for k in rng.integers(0, 1 << 52, 900 if c else 50)]
    rows += [(9, k) for k in range(300)]  # all keys share their leading bits
    df = spark.createDataFrame(rows, "c int, k long").repartition(5)
    want = {0: 17, 1: 0, 7: 900, 9: 123}
    sizes, cuts = radix(df, lambda s: want, bits=bits, fetched=fetched)
    assert sizes == {0: 50, 1: 900, 7: 900, 9: 300}
    for c, n in want.items():
        assert sum(k < cuts[c] for x, k in rows if x == c) == n


def test_equal_keys_stay_together(spark):
    df = spark.createDataFrame([(0, 5)] * 40 + [(0, 9)] * 3, "c int, k long")
    for fetched in (0, 100):
        _, cuts = radix(df, lambda s: {0: 10}, fetched=fetched)
        assert cuts == {0: 6}


def test_no_rows(spark):
    assert radix(spark.createDataFrame([], "c int, k long"), lambda s: {}) == ({}, {})
