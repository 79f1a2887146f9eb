"""S2 / M1–M5 — macro tables.

Part A series (percent units), one row per month of the book's calendar:

* unemployment ``u = clip(5 + 0.5·sin(6·i/(n−1)) + shock_i + ε, 3, 15)``,
  with ``shock_i = 2.5`` for month positions 24..29;
* GDP growth ``g = clip(3 − 0.4·(u − 5) + ε, −5, 6)``;
* house prices ``hpi_0 = 100, hpi_t = hpi_{t−1}·(1 + 0.05·g_t/100 + ε)``,
  computed as ``100·exp(Σ ln(1 + r))`` over a running window.

Noise ε is off by default; with ``noise=True`` it is a keyed normal draw per
month (reproducible). Part B's stress scenario is a linear ramp in fraction
units over 12 month-ends.

Both tables have one row per month, so their size is bounded by the calendar
(checked against ``MAX_BOOK_MONTHS``); the running window has no partition key
on purpose — it runs over that bounded table only, never at loan grain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clip, normal
from .loan_tape import MAX_BOOK_MONTHS, BookCalendar

# ---- fixed values: part A macro generator ----
UNEMP_BASE, UNEMP_AMP, UNEMP_PHASE_END = 5.0, 0.5, 6.0
SHOCK_FIRST, SHOCK_LAST, SHOCK_SIZE = 24, 29, 2.5
UNEMP_BOUNDS = (3.0, 15.0)
GDP_LEVEL, GDP_SLOPE, GDP_BOUNDS = 3.0, 0.4, (-5.0, 6.0)
HPI_START, HPI_DRIFT = 100.0, 0.05
NOISE_SD = {"unemployment_rate": 0.3, "gdp_growth": 0.4, "house_price_index": 0.005}
# ---- fixed values: part B stress ramp ----
RAMP_START = dt.date(2026, 1, 31)
RAMP_MONTHS = 12
RAMP_UNEMP = (0.05, 0.12)
RAMP_GDP = (0.02, -0.03)


def macro_series(spark: SparkSession, first_month: dt.date, n_months: int, *, noise: bool = False,
                 scenario: str | None = None) -> DataFrame:
    """Monthly macro path (part A units). Columns: month, unemployment_rate, gdp_growth, house_price_index."""
    if not 1 <= n_months <= MAX_BOOK_MONTHS:
        raise ValueError(f"n_months must be in 1..{MAX_BOOK_MONTHS}")
    step = UNEMP_PHASE_END / (n_months - 1) if n_months > 1 else 0.0
    i = F.col("id")

    def eps(name: str):
        if not noise:
            return F.lit(0.0)
        return normal(F.concat(F.lit(f"{scenario or 'base'}:{name}:"), i.cast("string")), "macro",
                      0.0, NOISE_SD[name])

    base = F.lit(UNEMP_BASE) + F.lit(UNEMP_AMP) * F.sin(i.cast("double") * F.lit(step))
    shock = F.when(i.between(SHOCK_FIRST, SHOCK_LAST), F.lit(SHOCK_SIZE)).otherwise(F.lit(0.0))
    df = spark.range(n_months).withColumns({
        "month": F.add_months(F.lit(first_month), i.cast("int")),
        "unemployment_rate": clip(base + shock + eps("unemployment_rate"), *UNEMP_BOUNDS),
    })
    df = df.withColumn(
        "gdp_growth",
        clip(F.lit(GDP_LEVEL) - F.lit(GDP_SLOPE) * (F.col("unemployment_rate") - F.lit(UNEMP_BASE))
             + eps("gdp_growth"), *GDP_BOUNDS))
    growth = F.when(i == 0, F.lit(0.0)).otherwise(
        F.lit(HPI_DRIFT) * F.col("gdp_growth") / F.lit(100.0) + eps("house_price_index"))
    running = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("house_price_index",
                       F.lit(HPI_START) * F.exp(F.sum(F.ln(F.lit(1.0) + growth)).over(running)))
    cols = ["month", "unemployment_rate", "gdp_growth", "house_price_index"]
    if scenario is not None:
        cols = [F.lit(scenario).alias("scenario")] + cols
    return df.select(*cols)


def book_macro(spark: SparkSession, calendar: BookCalendar, **kw) -> DataFrame:
    """Macro path spanning the book's booking months."""
    return macro_series(spark, calendar.first_month, calendar.n_months, **kw)


def ramp_scenario(spark: SparkSession, start: dt.date = RAMP_START, n_months: int = RAMP_MONTHS,
                  unemp=RAMP_UNEMP, gdp=RAMP_GDP) -> DataFrame:
    """M5 — linear ramp in fraction units over ``n_months`` month-ends (``date`` column)."""
    if not 1 <= n_months <= MAX_BOOK_MONTHS:
        raise ValueError(f"n_months must be in 1..{MAX_BOOK_MONTHS}")
    i = F.col("id").cast("double")
    denom = float(max(n_months - 1, 1))

    def lin(lo, hi):
        return F.lit(float(lo)) + i * F.lit(float(hi - lo)) / F.lit(denom)

    return spark.range(n_months).select(
        F.last_day(F.add_months(F.lit(start), F.col("id").cast("int"))).alias("date"),
        lin(*unemp).alias("unemployment_rate"),
        lin(*gdp).alias("gdp_growth"),
    )


def snapshot(macro: DataFrame, order_col: str = "month", cols=("unemployment_rate", "gdp_growth")) -> dict:
    """M6 — values of the last row by ``order_col`` (pandas ``iloc[-1]``), as scalars.

    The macro table is bounded by its calendar, so this is a one-row aggregate
    (``max_by``) brought to the driver, not a scan of loan data.
    """
    row = macro.agg(*[F.max_by(c, order_col).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}
