"""Exact quantiles / AUC against brute force on small fixtures, including a hot value."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspark.operators import backtest, reports
from creditspark.operators.ordered import exact_quantiles, exact_ranks


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_exact_quantiles_vs_numpy(spark, buckets):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=400), np.full(300, 0.25), rng.integers(0, 5, 200).astype(float)])
    y = rng.exponential(size=x.size)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = exact_quantiles(df, ["x", "y"], probs, buckets=buckets)
    for name, arr in (("x", x), ("y", y)):
        for p, value in zip(probs, got[name], strict=True):
            assert value == pytest.approx(float(np.quantile(arr, p)), rel=1e-12, abs=1e-12)


def test_ranks_are_exact_when_brackets_are_coarse(spark):
    """With accuracy 20 a bracket holds a fifth of the rows, and some miss their rank at first."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=5000), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(7)
    df = df.unionByName(spark.createDataFrame([(None,), (float("nan"),)], "x double"))
    ks = [0, 1, 2499, 2500, 4321, 4999]
    got = exact_ranks(df, {"x": "x"}, {"x": ks}, {"x": 5000}, accuracy=20)["x"]
    assert got == {k: np.sort(x)[k] for k in ks}
    assert exact_ranks(df, {"x": "x"}, {"x": [5000, -1]}, {"x": 5000})["x"] == {}
    assert exact_quantiles(df.where("x > 99"), ["x"]) == {"x": [None] * 3}


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = rng.gamma(2.0, size=500)
    flags = (vals > 2).astype(int)
    df = spark.createDataFrame([(float(v), int(f)) for v, f in zip(vals, flags)], "v double, f int")
    out = {r["variable"]: r for r in reports.describe(df, ["v", "f"], buckets=4).collect()}
    for name, arr in (("v", vals), ("f", flags.astype(float))):
        r = out[name]
        assert r["count"] == arr.size
        assert r["mean"] == pytest.approx(arr.mean(), rel=1e-12)
        assert r["std"] == pytest.approx(arr.std(ddof=1), rel=1e-10)
        assert r["min"] == arr.min() and r["max"] == arr.max()
        for p, col in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            assert r[col] == pytest.approx(float(np.quantile(arr, p)), rel=1e-12)


def test_describe_approx_close(spark):
    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("v"))
    r = reports.describe(df, ["v"], approx_accuracy=100000).first()
    assert r["p50"] == pytest.approx(5000.0, abs=1.0)


def test_auc_vs_brute_force_with_ties(spark):
    rng = np.random.default_rng(11)
    s = np.round(rng.uniform(size=300), 2)          # many ties
    s[:100] = 0.5                                   # a hot score on a third of rows
    y = (rng.uniform(size=300) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    for buckets in (1, 4, 32):
        got = backtest.auc(df, "s", "y", buckets=buckets).first()["auc"]
        assert got == pytest.approx(brute_auc(s, y), rel=1e-12)


def test_brier(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 1), (0.9, 0)], "s double, y int")
    assert backtest.brier(df, "s", "y").first()["brier"] == pytest.approx((0.04 + 0.09 + 0.81) / 3)


def test_stage_mix_shares_sum_to_one(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "stage int")
    rows = reports.stage_mix(df).collect()
    assert [r["stage"] for r in rows] == [1, 2, 3]
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["share"] == pytest.approx(0.5)


def test_describe_leaves_out_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None), (float("nan"), None)], "v double, w double")
    r = reports.describe(df, ["v", "w"]).collect()
    assert [tuple(x) for x in r] == [("v", 2.0, 1.5, pytest.approx(0.5**0.5), 1.0, 1.25, 1.5, 1.75, 2.0)]


def test_auc_rejects_what_it_cannot_rank(spark):
    df = spark.createDataFrame([(0.5, 1), (float("nan"), 0)], "s double, y int")
    with pytest.raises(ValueError, match="NaN"):
        backtest.auc(df, "s", "y")
    for y in (0, 1):
        with pytest.raises(ValueError, match="both classes"):
            backtest.auc(spark.createDataFrame([(0.5, y), (0.7, y)], "s double, y int"), "s", "y")


def test_stage3_rate_counts_loans_without_stage(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (None,)], "stage_ifrs9 int")
    assert reports.stage3_rate(df).first()[0] == 0.25


def test_stage_mix_migration(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, None), (None, 3)], "stage_ifrs9 int, stage_ifrs9_stressed int")
    got = {(r.scenario, r.stage_ifrs9): (r.loans, r.share) for r in reports.stage_mix_migration(df).collect()}
    assert got == {("base", 1): (2, 0.5), ("base", 2): (1, 0.25), ("base", 3): (1, 0.25),
                   ("stressed", 1): (1, 0.25), ("stressed", 2): (2, 0.5), ("stressed", 3): (1, 0.25)}
