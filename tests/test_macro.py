"""Macro tables (M1–M6, W1) and the strict booking-month lookup (J1)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from creditspark.operators.joins import lookup_macro_at_booking
from creditspark.operators.stress import pd_multiplier
from creditspark.sources.macro import macro_series, ramp_scenario, snapshot


def test_ramp_scenario(spark):
    rows = ramp_scenario(spark).orderBy("date").collect()
    assert len(rows) == 12
    assert rows[0]["date"] == dt.date(2026, 1, 31) and rows[-1]["date"] == dt.date(2026, 12, 31)
    assert rows[0]["unemployment_rate"] == pytest.approx(0.05) and rows[-1]["unemployment_rate"] == pytest.approx(0.12)
    assert rows[0]["gdp_growth"] == pytest.approx(0.02) and rows[-1]["gdp_growth"] == pytest.approx(-0.03)
    snap = snapshot(ramp_scenario(spark), "date")
    assert pd_multiplier(snap) == pytest.approx(1.45, rel=1e-12)


def test_macro_series_matches_loop(spark):
    n = 60
    rows = macro_series(spark, dt.date(2015, 1, 1), n).orderBy("month").collect()
    assert rows[0]["month"] == dt.date(2015, 1, 1) and rows[-1]["month"] == dt.date(2019, 12, 1)
    hpi = 100.0
    for i, r in enumerate(rows):
        base = 5 + 0.5 * math.sin(i * 6.0 / (n - 1)) + (2.5 if 24 <= i <= 29 else 0.0)
        u = min(max(base, 3.0), 15.0)
        g = min(max(3 - 0.4 * (u - 5), -5.0), 6.0)
        if i > 0:
            hpi *= 1 + 0.05 * g / 100
        assert r["unemployment_rate"] == pytest.approx(u, rel=1e-12)
        assert r["gdp_growth"] == pytest.approx(g, rel=1e-12)
        assert r["house_price_index"] == pytest.approx(hpi, rel=1e-12)


def test_macro_noise_is_keyed(spark):
    a = macro_series(spark, dt.date(2015, 1, 1), 24, noise=True).collect()
    b = macro_series(spark, dt.date(2015, 1, 1), 24, noise=True).collect()
    c = macro_series(spark, dt.date(2015, 1, 1), 24).collect()
    assert a == b and a != c


def test_snapshot_is_last_month(spark):
    m = macro_series(spark, dt.date(2015, 1, 1), 60)
    last = m.orderBy(F.col("month").desc()).first()
    assert snapshot(m) == {"unemployment_rate": last["unemployment_rate"], "gdp_growth": last["gdp_growth"]}


def test_strict_lookup_rejects_missing_month(spark):
    macro = macro_series(spark, dt.date(2015, 1, 1), 3)
    loans = spark.createDataFrame([(1, dt.date(2015, 2, 1)), (2, dt.date(2016, 1, 1))], "loan_id long, booking_month date")
    with pytest.raises(Exception):
        lookup_macro_at_booking(loans, macro).collect()
    ok = lookup_macro_at_booking(loans.where("loan_id = 1"), macro).first()
    assert ok["booking_unemp"] is not None


def test_strict_lookup_rejects_duplicate_months(spark):
    macro = macro_series(spark, dt.date(2015, 1, 1), 3)
    loans = spark.createDataFrame([(1, dt.date(2015, 2, 1))], "loan_id long, booking_month date")
    with pytest.raises(ValueError):
        lookup_macro_at_booking(loans, macro.unionByName(macro))
