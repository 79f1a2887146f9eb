"""P2–P16 — probability of default, loss given default, exposure, expected loss.

All functions are ``DataFrame -> DataFrame`` projections (one stage, no shuffle);
pass them to ``df.transform``. Parameters default to the reference's values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import Term, normal, require_columns
from ..functions import sqltext as X
from ..functions.core import with_exprs

# ---- fixed values: scorecard coefficients ----
# point-in-time 12-month PD (also used, with shocked macro inputs, for additive stress)
PIT_INTERCEPT = -4.0
PIT_TERMS = (
    Term(0.02, "age", 45.0),
    Term(-5e-6, "annual_income"),
    Term(8e-5, "loan_amount"),
    Term(-0.007, "credit_score"),
    Term(7.0, "dti_ratio"),
    Term(3.0, "utilization_ratio"),
    Term(0.25, "num_inquiries_12m"),
    Term(-0.03, "employment_years"),
    Term(0.35, "unemployment_rate"),
    Term(-0.10, "gdp_growth"),
    Term(0.15, "vintage_index"),
)
# origination PD: no macro terms, weaker vintage effect
ORIG_INTERCEPT = -4.0
ORIG_TERMS = (
    Term(0.02, "age", 45.0),
    Term(-5e-6, "annual_income"),
    Term(5e-5, "loan_amount"),
    Term(-0.006, "credit_score"),
    Term(5.0, "dti_ratio"),
    Term(2.0, "utilization_ratio"),
    Term(0.20, "num_inquiries_12m"),
    Term(-0.02, "employment_years"),
    Term(0.10, "vintage_index"),
)
LOGIT_BOUND = 10.0
PD_FLOOR, PD_CAP = 0.0001, 0.99
DPD30_PD, DPD90_PD = 0.25, 0.40
LGD_BASE, LGD_SCORE, LGD_UNEMP, LGD_HPI = 0.15, 0.0009, 0.01, 0.00005
LGD_BOUNDS = (0.05, 0.95)
LIFE_SLOPE, PD_LIFETIME_CAP = 0.6, 0.999

_BORROWER = ("age", "annual_income", "loan_amount", "credit_score", "dti_ratio",
             "utilization_ratio", "num_inquiries_12m", "employment_years", "vintage_index")


def pit_pd(df: DataFrame, snapshot: Mapping[str, float], *, out: str = "pd_12m") -> DataFrame:
    """P4 — 12-month point-in-time PD at a macro snapshot (percent units).

    ``snapshot`` holds ``unemployment_rate`` and ``gdp_growth`` scalars (M6).
    """
    require_columns(df, *_BORROWER)
    z = X.linear_score(PIT_INTERCEPT, PIT_TERMS, snapshot)
    return with_exprs(df, {out: X.sigmoid(z, LOGIT_BOUND)})


def origination_pd(df: DataFrame, *, out: str = "pd_12m_origination") -> DataFrame:
    """P5 — PD at initial recognition."""
    require_columns(df, *_BORROWER)
    return with_exprs(df, {out: X.sigmoid(X.linear_score(ORIG_INTERCEPT, ORIG_TERMS), LOGIT_BOUND)})


def current_pd(df: DataFrame, *, factor_col: str = "pd_mult", base_col: str = "pd_12m_origination",
               out: str = "pd_12m", floor: float = PD_FLOOR, cap: float = PD_CAP) -> DataFrame:
    """P6 — current PD = clip(origination PD × deterioration factor)."""
    require_columns(df, factor_col, base_col)
    return with_exprs(df, {out: X.clip(f"{X.ident(base_col)} * {X.ident(factor_col)}", floor, cap)})


def simulate_default(df: DataFrame, *, pd_col: str = "pd_12m", draw_col: str = "default_draw",
                     scale: float = 1.0, cap: float | None = None, out: str = "default_12m") -> DataFrame:
    """D2 — default outcome 1 when the keyed draw falls below ``min(scale·pd, cap)``.

    A NULL or NaN PD gives 0 (``least`` alone would skip the NULL and default at ``cap``).
    """
    require_columns(df, pd_col, draw_col)
    pd, draw = X.ident(pd_col), X.ident(draw_col)
    hit = f"{draw} < {pd} * {X.num(scale)}" if scale != 1.0 else f"{draw} < {pd}"
    if cap is not None:
        hit += f" AND {draw} < {X.num(cap)}"
    return with_exprs(df, {out: X.flag(f"{hit} AND NOT isnan({pd})")})


def pd_ratio_and_flags(df: DataFrame, *, pd_col: str = "pd_12m", base_col: str = "pd_12m_origination",
                       default_col: str = "default_12m", dpd30_pd: float = DPD30_PD,
                       dpd90_pd: float = DPD90_PD) -> DataFrame:
    """P7 + P8 — zero-safe PD ratio and the 30/90 days-past-due proxies."""
    require_columns(df, pd_col, base_col, default_col)
    d, pd = f"{X.ident(default_col)} = 1", X.ident(pd_col)
    return with_exprs(df, {
        "pd_ratio": f"{pd} / {X.zero_safe(X.ident(base_col))}",
        "dpd_30_plus": X.flag(f"{d} OR {pd} > {X.num(dpd30_pd)}"),
        "dpd_90_plus": X.flag(f"{d} OR {pd} > {X.num(dpd90_pd)}"),
    })


def lgd_from_score(df: DataFrame, *, noise_sd: float = 0.0, key_col: str = "loan_id",
                   noise_salt: int = 13, out: str = "lgd") -> DataFrame:
    """P9 — LGD from credit score and booking-month macro (percent units)."""
    require_columns(df, "credit_score", "booking_unemp", "booking_hpi")
    raw = (f"({X.num(LGD_BASE)} + {X.num(LGD_SCORE)} * ({X.num(850.0)} - credit_score)) + "
           f"({X.num(LGD_UNEMP)} * (booking_unemp - {X.num(5.0)}) - {X.num(LGD_HPI)} * (booking_hpi - {X.num(100.0)}))")
    if noise_sd:
        df = df.withColumn("_lgd_noise", normal(key_col, noise_salt, 0.0, noise_sd))
        raw = f"({raw}) + _lgd_noise"
        return with_exprs(df, {out: X.clip(raw, *LGD_BOUNDS)}).drop("_lgd_noise")
    return with_exprs(df, {out: X.clip(raw, *LGD_BOUNDS)})


def ead(df: DataFrame, *, factor_col: str = "ead_factor", out: str = "ead") -> DataFrame:
    """P10 — exposure at default = loan amount × drawn factor."""
    require_columns(df, "loan_amount", factor_col)
    return with_exprs(df, {out: f"loan_amount * {X.ident(factor_col)}"})


def ecl_term(df: DataFrame, *, pd_col: str = "pd_12m", default_col: str = "default_12m") -> DataFrame:
    """P11–P14 — realised loss, 12m ECL, lifetime PD by term, lifetime ECL (undiscounted)."""
    require_columns(df, "ead", "lgd", pd_col, default_col, "term_months")
    life = f"({X.num(1.0)} + (term_months / {X.num(12.0)} - {X.num(1.0)}) * {X.num(LIFE_SLOPE)})"
    pd = X.ident(pd_col)
    df = with_exprs(df, {
        "realized_loss_12m": f"ead * lgd * {X.ident(default_col)}",
        "ecl_12m": f"ead * lgd * {pd}",
        "pd_lifetime": X.clip(f"{pd} * {life}", 0.0, PD_LIFETIME_CAP),
    })
    return with_exprs(df, {"ecl_lifetime": "ead * lgd * pd_lifetime"})


def ecl_multiplier(df: DataFrame, *, pd_col: str = "pd_12m", life_col: str = "life_mult") -> DataFrame:
    """P12 + P15 — 12m ECL = ead·pd·lgd; lifetime ECL = 12m ECL × lifetime multiplier."""
    require_columns(df, "ead", "lgd", pd_col, life_col)
    df = with_exprs(df, {"ecl_12m": f"ead * {X.ident(pd_col)} * lgd"})
    return with_exprs(df, {"ecl_lifetime": f"ecl_12m * {X.ident(life_col)}"})


def effective_maturity(df: DataFrame, *, out: str = "effective_maturity_years") -> DataFrame:
    """P16 — maturity in years from the term when no maturity column is present."""
    if out in df.columns:
        return df
    require_columns(df, "term_months")
    return with_exprs(df, {out: f"term_months / {X.num(12.0)}"})
