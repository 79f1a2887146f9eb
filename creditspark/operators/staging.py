"""T1–T4 — IFRS 9 impairment stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require_columns
from ..functions import sqltext as X
from ..functions.core import with_exprs

# ---- fixed values: staging thresholds ----
PD_BANDS = (0.02, 0.10)          # stage 1 below 2%, stage 2 below 10%, else stage 3
SICR_PD_RATIO = 1.5
SICR_ABS_PD = 0.10


def stage_by_pd_band(df: DataFrame, *, pd_col: str = "pd_12m", bands=PD_BANDS, out: str = "stage") -> DataFrame:
    """T1 — stage from PD bands; a missing PD gets stage 0 (no band matched)."""
    lo, hi = bands
    p = X.ident(pd_col)
    return with_exprs(df, {out: f"(CASE WHEN {p} < {X.num(lo)} THEN 1 "
                                f"WHEN {p} >= {X.num(lo)} AND {p} < {X.num(hi)} THEN 2 "
                                f"WHEN {p} >= {X.num(hi)} THEN 3 ELSE 0 END)"})


def sicr_stage_sql(*, pd_ratio_threshold: float = SICR_PD_RATIO, abs_pd_threshold: float = SICR_ABS_PD,
                   backstop_30dpd: bool = True, default_90dpd: bool = True, pd_col: str = "pd_12m",
                   ratio_col: str = "pd_ratio", default_col: str = "default_12m",
                   dpd30_col: str = "dpd_30_plus", dpd90_col: str = "dpd_90_plus") -> str:
    """The T2 rule as SQL: stage 3 on default (or 90 DPD), else 2 on SICR, else 1.

    NULL comparisons count as false, like NumPy masks over NaN.
    """
    def true(c: str) -> str:
        return f"coalesce({c}, false)"

    s3 = true(f"{X.ident(default_col)} = 1")
    if default_90dpd:
        s3 += " OR " + true(f"{X.ident(dpd90_col)} = 1")
    sicr = (true(f"{ratio_col if '(' in ratio_col else X.ident(ratio_col)} >= {X.num(pd_ratio_threshold)}")
            + " OR " + true(f"{X.ident(pd_col)} >= {X.num(abs_pd_threshold)}"))
    if backstop_30dpd:
        sicr += " OR " + true(f"{X.ident(dpd30_col)} = 1")
    return f"(CASE WHEN {s3} THEN 3 WHEN {sicr} THEN 2 ELSE 1 END)"


def sicr_stage(df: DataFrame, *, out: str = "stage_ifrs9", **params) -> DataFrame:
    """T2/T3 — SICR staging with the reference's default thresholds."""
    require_columns(df, "pd_12m", "pd_ratio", "default_12m", "dpd_30_plus", "dpd_90_plus")
    return with_exprs(df, {out: sicr_stage_sql(**params)})


def restage_stressed(df: DataFrame, *, stressed_pd_col: str = "pd_12m_stressed",
                     base_col: str = "pd_12m_origination", out: str = "stage_ifrs9_stressed",
                     refresh_flags: bool = False, **params) -> DataFrame:
    """T4 — re-stage with stressed PD and PD ratio, as sibling columns.

    Like the reference, default and DPD flags are carried over unchanged, so the
    stage-3 set never moves; ``refresh_flags=True`` re-derives the DPD proxies
    from the stressed PD instead (our option).
    """
    require_columns(df, stressed_pd_col, base_col)
    sp = X.ident(stressed_pd_col)
    df = with_exprs(df, {"pd_ratio_stressed": f"{sp} / {X.zero_safe(X.ident(base_col))}"})
    dpd30, dpd90 = "dpd_30_plus", "dpd_90_plus"
    if refresh_flags:
        df = with_exprs(df, {
            "dpd_30_plus_stressed": X.flag(f"default_12m = 1 OR {sp} > {X.num(0.25)}"),
            "dpd_90_plus_stressed": X.flag(f"default_12m = 1 OR {sp} > {X.num(0.40)}"),
        })
        dpd30, dpd90 = "dpd_30_plus_stressed", "dpd_90_plus_stressed"
    rule = sicr_stage_sql(pd_col=stressed_pd_col, ratio_col="pd_ratio_stressed",
                          dpd30_col=dpd30, dpd90_col=dpd90, **params)
    return with_exprs(df, {out: rule})
