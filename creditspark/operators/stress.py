"""M7–M9 — macro stress on the loan book."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import require_columns
from ..functions import sqltext as X
from ..functions.core import with_exprs
from .risk import LOGIT_BOUND, PD_CAP, PD_FLOOR, PIT_INTERCEPT, PIT_TERMS

# ---- fixed values: stress parameters ----
UNEMP_SHOCK, GDP_SHOCK = 3.0, -4.0          # additive, percent units
# scenarios of the ``stress_scenarios`` query: the reference's shock, half of it, and half as much again
SCENARIOS = {"half": (1.5, -2.0), "full": (3.0, -4.0), "severe": (4.5, -6.0)}
MULT_UNEMP_BASE, MULT_UNEMP, MULT_GDP = 0.05, 3.0, 8.0   # multiplicative, fraction units


def shock_macro(macro: DataFrame, *, unemp_shock: float = UNEMP_SHOCK, gdp_shock: float = GDP_SHOCK) -> DataFrame:
    """M7 — parallel shock added as new columns."""
    return macro.withColumns({
        "unemployment_rate_stressed": F.col("unemployment_rate") + F.lit(unemp_shock),
        "gdp_growth_stressed": F.col("gdp_growth") + F.lit(gdp_shock),
    })


def stress_additive(df: DataFrame, shocked: Mapping[str, float]) -> DataFrame:
    """M8 — re-score the PIT PD at a shocked last snapshot (of ``shock_macro``'s table); stressed 12m ECL.

    Stage, lifetime PD and lifetime ECL are left as they are.
    """
    require_columns(df, "ead", "lgd")
    df = with_exprs(df, {"pd_12m_stressed": X.sigmoid(X.linear_score(PIT_INTERCEPT, PIT_TERMS, shocked), LOGIT_BOUND)})
    return with_exprs(df, {"ecl_12m_stressed": "ead * lgd * pd_12m_stressed"})


def stress_scenarios(df: DataFrame, shocked: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """M8 for several scenarios in one pass: ``pd_12m_<name>`` and ``ecl_12m_<name>`` for each.

    ``shocked`` maps a scenario's name to its shocked last snapshot.
    """
    require_columns(df, "ead", "lgd")
    df = with_exprs(df, {f"pd_12m_{name}": X.sigmoid(X.linear_score(PIT_INTERCEPT, PIT_TERMS, snap), LOGIT_BOUND)
                         for name, snap in shocked.items()})
    return with_exprs(df, {f"ecl_12m_{name}": f"ead * lgd * pd_12m_{name}" for name in shocked})


def pd_multiplier(snapshot: Mapping[str, float]) -> float:
    """m = 1 + 3·(u − 0.05) − 8·g at the scenario's last month (fraction units)."""
    return 1.0 + MULT_UNEMP * (snapshot["unemployment_rate"] - MULT_UNEMP_BASE) - MULT_GDP * snapshot["gdp_growth"]


def stress_multiplier(df: DataFrame, snapshot: Mapping[str, float]) -> DataFrame:
    """M9 — stressed PD = clip(pd·m, 1e-4, 0.99); stressed 12m ECL = ead·pd_s·lgd."""
    require_columns(df, "pd_12m", "ead", "lgd")
    m = pd_multiplier(snapshot)
    df = with_exprs(df, {"pd_12m_stressed": X.clip(f"pd_12m * {X.num(m)}", PD_FLOOR, PD_CAP)})
    return with_exprs(df, {"ecl_12m_stressed": "ead * pd_12m_stressed * lgd"})
