"""DuckDB SQL for every registered query with an SQL equivalent.

The SQL re-states each formula apart from the Spark plan (CTEs over the
pre-registered ``orders`` and ``customer`` views). Coefficients, bands and salts
are those of the code under test; the tests hold them against values typed in
from the model's definition (``tests/test_anchors.py``). Doubles are rounded as
``registry.present`` does, money to 4 places and ratios to 9. Queries without an
entry here get a rows-only check.
"""

from __future__ import annotations

import math

from ..operators import capital, risk, staging, stress
from ..operators.backtest import CHAMPION_BOUND, CHAMPION_INTERCEPT, CHAMPION_TERMS, FEATURES, LOGIT_BOUND, SPLIT_SALT, TEST_SIZE
from ..operators.reports import KPI_LABELS
from ..sources import macro as M
from ..sources.loan_tape import SALT, TERM_CHOICES, TERM_CHOICES_A, TERM_WEIGHTS
from ..sources.sinks import FINAL_COLS
from ..functions import gaussian as N
from .registry import ALT_SICR, DESCRIBE_COLS, MONEY_PLACES, RATIO_PLACES, places


def d(x: float) -> str:
    """A double literal (DuckDB reads ``0.5`` as DECIMAL otherwise)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def clip(x: str, lo=None, hi=None) -> str:
    if lo is not None:
        x = f"greatest({x}, {d(lo)})"
    if hi is not None:
        x = f"least({x}, {d(hi)})"
    return x


def U(salt, key: str = "loan_id") -> str:
    group, part = (salt // 4, salt % 4) if isinstance(salt, int) else (salt, 0)
    h = f"md5(CAST({key} AS VARCHAR) || ':{group}')"
    return f"(CAST(CAST(('0x' || substr({h}, {1 + 8 * part}, 8)) AS BIGINT) AS DOUBLE) / {d(4294967296.0)})"


def sigmoid(z: str, bound: float = risk.LOGIT_BOUND) -> str:
    return f"({d(1.0)} / ({d(1.0)} + exp(-({clip(z, -bound, bound)}))))"


def score(intercept: float, terms, values: dict[str, str]) -> str:
    acc = d(intercept)
    for t in terms:
        if t.column in values:
            x = values[t.column]
        else:
            x = f"CAST({t.column} AS DOUBLE)"
        if t.center:
            x = f"({x} - {d(t.center)})"
        acc = f"({acc} + {d(t.coef)} * {x})"
    return acc


def rnd(x: str, alias: str) -> str:
    return f"(round({x}, {places(alias)}) + {d(0.0)}) AS {alias}"


def horner_low(x: str, coefs) -> str:
    acc = d(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = f"({acc} * {x} + {d(c)})"
    return acc


def horner_high(x: str, coefs) -> str:
    acc = d(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {d(c)})"
    return acc


def ppf_sql(p: str) -> str:
    q = f"({p} - {d(0.5)})"
    rc = f"({d(0.180625)} - {q} * {q})"
    rt = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE {d(1.0)} - {p} END))"
    central = f"({q} * {horner_low(rc, N.PPND16_A)} / {horner_low(rc, N.PPND16_B)})"
    t1, t2 = f"({rt} - {d(1.6)})", f"({rt} - {d(5.0)})"
    mag = (f"(CASE WHEN {rt} <= {d(5.0)} THEN {horner_low(t1, N.PPND16_C)} / {horner_low(t1, N.PPND16_D)} "
           f"ELSE {horner_low(t2, N.PPND16_E)} / {horner_low(t2, N.PPND16_F)} END)")
    return (f"(CASE WHEN abs({q}) <= {d(0.425)} THEN {central} "
            f"ELSE (CASE WHEN {q} < 0 THEN {d(-1.0)} ELSE {d(1.0)} END) * {mag} END)")


def cdf_sql(x: str) -> str:
    a = f"abs({x})"
    e = f"exp(-({a} * {a}) / {d(2.0)})"
    near = f"({e} * {horner_high(a, N.CDF_NUM)} / {horner_high(a, N.CDF_DEN)})"
    cf = f"({a} + {d(0.65)})"
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = f"({a} + {d(k)} / {cf})"
    far = f"({e} / {cf} / {d(N.SQRT_2PI)})"
    lower = (f"(CASE WHEN {a} > {d(N.CDF_CUTOFF)} THEN {d(0.0)} WHEN {a} < {d(N.CDF_SPLIT)} THEN {near} "
             f"ELSE {far} END)")
    return f"(CASE WHEN {x} > 0 THEN {d(1.0)} - {lower} ELSE {lower} END)"


def _term_case(choices=TERM_CHOICES) -> str:
    total = float(sum(TERM_WEIGHTS))
    acc, parts = 0.0, []
    for v, w in zip(choices[:-1], TERM_WEIGHTS[:-1]):
        acc += float(w) / total
        parts.append(f"WHEN {U(SALT['term_months'])} < {d(acc)} THEN {v}")
    return f"CAST(CASE {' '.join(parts)} ELSE {choices[-1]} END AS INTEGER)"


def _stage_sicr(pd: str, ratio: str, dflt: str, dpd30: str, dpd90: str, *, pd_ratio_threshold=staging.SICR_PD_RATIO,
                abs_pd_threshold=staging.SICR_ABS_PD, backstop_30dpd=True, default_90dpd=True) -> str:
    s3 = f"coalesce({dflt} = 1, false)"
    if default_90dpd:
        s3 += f" OR coalesce({dpd90} = 1, false)"
    sicr = f"coalesce({ratio} >= {d(pd_ratio_threshold)}, false) OR coalesce({pd} >= {d(abs_pd_threshold)}, false)"
    if backstop_30dpd:
        sicr += f" OR coalesce({dpd30} = 1, false)"
    return f"CAST(CASE WHEN {s3} THEN 3 WHEN {sicr} THEN 2 ELSE 1 END AS INTEGER)"


# ---------------------------------------------------------------------------------------------
# CTE library
# ---------------------------------------------------------------------------------------------

_PIT_VALUES = {"unemployment_rate": "s.unemployment_rate", "gdp_growth": "s.gdp_growth"}
_PIT_STRESSED = {"unemployment_rate": f"(s.unemployment_rate + {d(stress.UNEMP_SHOCK)})",
                 "gdp_growth": f"(s.gdp_growth + {d(stress.GDP_SHOCK)})"}
_FIRST_BAND, _SECOND_BAND = staging.PD_BANDS

CTES: dict[str, tuple[list[str], str]] = {}
#: Stages that are computed once: inlined, the nested normal functions take minutes to plan.
MATERIALIZED = {"irb1", "irb2", "irb3", "z"}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("cal", [], """
  SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_month,
         CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS last_month,
         (year(max(o_orderdate)) - year(min(o_orderdate))) * 12
           + (month(max(o_orderdate)) - month(min(o_orderdate))) + 1 AS n_months
  FROM orders""")

cte("tape", ["cal"], f"""
  SELECT o.o_orderkey AS loan_id, o.o_custkey AS customer_id,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS booking_month,
         CAST(year(o.o_orderdate) AS INTEGER) AS booking_year,
         CAST(year(o.o_orderdate) - year(cal.first_month) AS INTEGER) AS vintage_index,
         CAST(21 + c.c_custkey % 54 AS DOUBLE) AS age,
         {clip(f"{d(15000.0)} + (c.c_acctbal + {d(1000.0)}) * {d(12.0)}", 15000.0, 300000.0)} AS annual_income,
         CAST({d(300.0)} + floor({d(550.0)} * ({d(0.35)} + {d(0.65)} * {U(SALT['credit_score'], 'o.o_orderkey')}))
              AS DOUBLE) AS credit_score,
         CAST(floor({d(35.0)} * {U(SALT['employment_years'], 'o.o_orderkey')}) AS DOUBLE) AS employment_years,
         {d(0.1)} + {d(0.4)} * {U(SALT['dti_ratio'], 'o.o_orderkey')} AS dti_ratio,
         {U(SALT['utilization_ratio'], 'o.o_orderkey')} AS utilization_ratio,
         CAST(floor({d(6.0)} * {U(SALT['num_inquiries_12m'], 'o.o_orderkey')}) AS INTEGER) AS num_inquiries_12m,
         {clip(f"o.o_totalprice / {d(5.0)}", 10000.0, 100000.0)} AS loan_amount,
         {_term_case().replace('loan_id', 'o.o_orderkey')} AS term_months,
         {d(5.0)} + {d(19.0)} * {U(SALT['interest_rate'], 'o.o_orderkey')} AS interest_rate
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey CROSS JOIN cal""")

cte("ids", ["cal"], "SELECT unnest(generate_series(0, n_months - 1)) AS i, first_month, n_months FROM cal")

cte("mac0", ["ids"], f"""
  SELECT i, CAST(first_month + to_months(CAST(i AS INTEGER)) AS DATE) AS month,
         {clip(f"{d(M.UNEMP_BASE)} + {d(M.UNEMP_AMP)} * sin(CAST(i AS DOUBLE) * "
               f"(CASE WHEN n_months > 1 THEN {d(M.UNEMP_PHASE_END)} / CAST(n_months - 1 AS DOUBLE) ELSE {d(0.0)} END))"
               f" + (CASE WHEN i BETWEEN {M.SHOCK_FIRST} AND {M.SHOCK_LAST} THEN {d(M.SHOCK_SIZE)} ELSE {d(0.0)} END)"
               f" + {d(0.0)}", *M.UNEMP_BOUNDS)} AS unemployment_rate
  FROM ids""")

cte("mac1", ["mac0"], f"""
  SELECT i, month, unemployment_rate,
         {clip(f"{d(M.GDP_LEVEL)} - {d(M.GDP_SLOPE)} * (unemployment_rate - {d(M.UNEMP_BASE)}) + {d(0.0)}",
               *M.GDP_BOUNDS)} AS gdp_growth
  FROM mac0""")

cte("mac", ["mac1"], f"""
  SELECT month, unemployment_rate, gdp_growth,
         {d(M.HPI_START)} * exp(sum(ln({d(1.0)} + (CASE WHEN i = 0 THEN {d(0.0)}
              ELSE {d(M.HPI_DRIFT)} * gdp_growth / {d(100.0)} + {d(0.0)} END)))
           OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS house_price_index
  FROM mac1""")

cte("snap", ["mac"], "SELECT unemployment_rate, gdp_growth FROM mac ORDER BY month DESC LIMIT 1")

cte("tapem", ["tape", "mac"], f"""
  SELECT t.* REPLACE ({_term_case(TERM_CHOICES_A).replace('loan_id', 't.loan_id')} AS term_months),
         m.unemployment_rate AS booking_unemp, m.gdp_growth AS booking_gdp_growth,
         m.house_price_index AS booking_hpi
  FROM tape t JOIN mac m ON t.booking_month = m.month""")

cte("pa0", ["tapem", "snap"], f"""
  SELECT t.*, {sigmoid(score(risk.PIT_INTERCEPT, risk.PIT_TERMS, _PIT_VALUES))} AS pd_12m,
         {sigmoid(score(risk.PIT_INTERCEPT, risk.PIT_TERMS, _PIT_STRESSED))} AS pd_12m_stressed,
         {clip(f"({d(risk.LGD_BASE)} + {d(risk.LGD_SCORE)} * ({d(850.0)} - credit_score)) + "
               f"({d(risk.LGD_UNEMP)} * (booking_unemp - {d(5.0)}) - {d(risk.LGD_HPI)} * (booking_hpi - {d(100.0)}))",
               *risk.LGD_BOUNDS)} AS lgd,
         loan_amount * ({d(0.6)} + {d(0.5)} * {U(SALT['ead_factor'])}) AS ead,
         {U(SALT['default'])} AS default_draw
  FROM tapem t CROSS JOIN snap s""")

cte("pa1", ["pa0"], f"""
  SELECT *, CAST(CASE WHEN default_draw < pd_12m THEN 1 ELSE 0 END AS INTEGER) AS default_12m,
         {clip(f"pd_12m * ({d(1.0)} + (CAST(term_months AS DOUBLE) / {d(12.0)} - {d(1.0)}) * {d(risk.LIFE_SLOPE)})",
               0.0, risk.PD_LIFETIME_CAP)} AS pd_lifetime
  FROM pa0""")

cte("pa", ["pa1"], f"""
  SELECT *, ead * lgd * default_12m AS realized_loss_12m, ead * lgd * pd_12m AS ecl_12m,
         ead * lgd * pd_lifetime AS ecl_lifetime,
         ead * lgd * pd_12m_stressed AS ecl_12m_stressed,
         CAST(CASE WHEN pd_12m < {d(_FIRST_BAND)} THEN 1
                   WHEN pd_12m >= {d(_FIRST_BAND)} AND pd_12m < {d(_SECOND_BAND)} THEN 2
                   WHEN pd_12m >= {d(_SECOND_BAND)} THEN 3 ELSE 0 END AS INTEGER) AS stage
  FROM pa1""")

cte("pb0", ["tape"], f"""
  SELECT *, {sigmoid(score(risk.ORIG_INTERCEPT, risk.ORIG_TERMS, {}))} AS pd_12m_origination,
         {d(0.8)} + {d(1.7)} * {U(SALT['pd_mult'])} AS pd_mult,
         {U(SALT['default'])} AS default_draw,
         loan_amount * ({d(0.8)} + {d(0.4)} * {U(SALT['ead_factor'])}) AS ead,
         {d(0.8)} * pow({U(SALT['lgd'])}, {d(4.0)}) AS lgd,
         {d(2.0)} + {d(3.0)} * {U(SALT['life_mult'])} AS life_mult
  FROM tape""")

cte("pb1", ["pb0"], f"""
  SELECT *, {clip("pd_12m_origination * pd_mult", risk.PD_FLOOR, risk.PD_CAP)} AS pd_12m FROM pb0""")

cte("pb2", ["pb1"], f"""
  SELECT *, CAST(CASE WHEN default_draw < least(pd_12m * {d(2.0)}, {d(0.5)}) AND pd_12m IS NOT NULL THEN 1 ELSE 0 END AS INTEGER)
              AS default_12m,
         pd_12m / (CASE WHEN pd_12m_origination = 0 THEN {d(1e-6)} ELSE pd_12m_origination END) AS pd_ratio
  FROM pb1""")

cte("pb3", ["pb2"], f"""
  SELECT *, CAST(CASE WHEN default_12m = 1 OR pd_12m > {d(risk.DPD30_PD)} THEN 1 ELSE 0 END AS INTEGER) AS dpd_30_plus,
         CAST(CASE WHEN default_12m = 1 OR pd_12m > {d(risk.DPD90_PD)} THEN 1 ELSE 0 END AS INTEGER) AS dpd_90_plus
  FROM pb2""")

cte("pb", ["pb3"], f"""
  SELECT *, {_stage_sicr('pd_12m', 'pd_ratio', 'default_12m', 'dpd_30_plus', 'dpd_90_plus')} AS stage_ifrs9,
         {_stage_sicr('pd_12m', 'pd_ratio', 'default_12m', 'dpd_30_plus', 'dpd_90_plus', **ALT_SICR)} AS stage_alt,
         ead * pd_12m * lgd AS ecl_12m,
         ead * pd_12m * lgd * life_mult AS ecl_lifetime
  FROM pb3""")

cte("ramp", [], f"""
  SELECT i, CAST(last_day(DATE '{M.RAMP_START.isoformat()}' + to_months(CAST(i AS INTEGER))) AS DATE) AS date,
         {d(M.RAMP_UNEMP[0])} + CAST(i AS DOUBLE) * {d(M.RAMP_UNEMP[1] - M.RAMP_UNEMP[0])}
            / {d(max(M.RAMP_MONTHS - 1, 1))} AS unemployment_rate,
         {d(M.RAMP_GDP[0])} + CAST(i AS DOUBLE) * {d(M.RAMP_GDP[1] - M.RAMP_GDP[0])}
            / {d(max(M.RAMP_MONTHS - 1, 1))} AS gdp_growth
  FROM (SELECT unnest(generate_series(0, {M.RAMP_MONTHS - 1})) AS i)""")

cte("rsnap", ["ramp"], f"""
  SELECT {d(1.0)} + {d(stress.MULT_UNEMP)} * (unemployment_rate - {d(stress.MULT_UNEMP_BASE)})
         - {d(stress.MULT_GDP)} * gdp_growth AS m
  FROM ramp ORDER BY date DESC LIMIT 1""")

cte("pbs0", ["pb", "rsnap"], f"""
  SELECT p.*, {clip("p.pd_12m * r.m", risk.PD_FLOOR, risk.PD_CAP)} AS pd_12m_stressed
  FROM pb p CROSS JOIN rsnap r""")

cte("pbs", ["pbs0"], f"""
  SELECT *, ead * pd_12m_stressed * lgd AS ecl_12m_stressed,
         pd_12m_stressed / (CASE WHEN pd_12m_origination = 0 THEN {d(1e-6)} ELSE pd_12m_origination END)
           AS pd_ratio_stressed,
         {_stage_sicr('pd_12m_stressed',
                      f"(pd_12m_stressed / (CASE WHEN pd_12m_origination = 0 THEN {d(1e-6)} ELSE pd_12m_origination END))",
                      'default_12m', 'dpd_30_plus', 'dpd_90_plus')} AS stage_ifrs9_stressed
  FROM pbs0""")

_GRADE_CASE = "CASE " + " ".join(f"WHEN pd_12m < {d(u)} THEN '{g}'" for g, u, _ in capital.GRADES[:-1]) + \
    f" ELSE '{capital.GRADES[-1][0]}' END"
_RW_CASE = "CASE " + " ".join(f"WHEN pd_12m < {d(u)} THEN {d(rw)}" for g, u, rw in capital.GRADES[:-1]) + \
    f" ELSE {d(capital.GRADES[-1][2])} END"

cte("std", ["pb"], f"""
  SELECT *, {_GRADE_CASE} AS basel_grade, {_RW_CASE} AS basel_rw,
         ead * ({_RW_CASE}) AS rwa_standardised,
         ead * ({_RW_CASE}) * {d(capital.CAPITAL_RATIO)} AS capital_required_std
  FROM pb""")

cte("z", ["pb"], f"""
  SELECT loan_id, pd_12m, {ppf_sql('pd_12m')} AS z_pd FROM pb""")

cte("irb0", ["pb"], f"""
  SELECT *, {clip('pd_12m', *capital.IRB_PD_BOUNDS)} AS ip,
         {clip('lgd', *capital.IRB_LGD_BOUNDS)} AS il,
         CAST(term_months AS DOUBLE) / {d(12.0)} AS effective_maturity_years
  FROM pb""")

_W = f"(({d(1.0)} - exp({d(-capital.R_DECAY)} * ip)) / {d(1.0 - math.exp(-capital.R_DECAY))})"

cte("irb1", ["irb0"], f"""
  SELECT *, {d(capital.R_LOW)} * {_W} + {d(capital.R_HIGH)} * ({d(1.0)} - {_W}) AS rho,
         {d(capital.B_A)} - {d(capital.B_B)} * ln(ip) AS bb,
         {ppf_sql('ip')} AS zpd
  FROM irb0""")

cte("irb2", ["irb1"], f"""
  SELECT *, (zpd + sqrt(rho) * {d(N.Z_999)}) / sqrt({d(1.0)} - rho) AS xx,
         ({d(1.0)} + (effective_maturity_years - {d(capital.M_CENTER)}) * bb) / ({d(1.0)} - {d(capital.M_SLOPE)} * bb) AS adj
  FROM irb1""")

cte("irb3", ["irb2"], f"""
  SELECT *, (il * {cdf_sql('xx')} - il * ip) * adj AS irb_cap_ratio_per_ead FROM irb2""")

cte("irb", ["irb3"], f"""
  SELECT *, {d(capital.RWA_SCALE)} * irb_cap_ratio_per_ead * ead AS rwa_irb,
         {d(capital.RWA_SCALE)} * irb_cap_ratio_per_ead * ead * {d(capital.CAPITAL_RATIO)} AS capital_required_irb
  FROM irb3""")


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({CTES[n][1]}\n)" for n in order) + "\n"


def sql(ctes, select: str) -> str:
    return with_ctes(*ctes) + select


def _stage_mix_sql(src: str, stage_col: str, out: str) -> str:
    return (f"SELECT {stage_col} AS {out}, count(*) AS loans, "
            f"{rnd(f'CAST(count(*) AS DOUBLE) / sum(count(*)) OVER ()', 'share')} "
            f"FROM {src} WHERE {stage_col} IS NOT NULL GROUP BY {stage_col}")


def _describe_sql() -> str:
    parts = []
    for c in DESCRIBE_COLS:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS variable, {rnd(f'CAST(count({v}) AS DOUBLE)', 'count')}, {rnd(f'avg({v})', 'mean')}, "
            f"{rnd(f'stddev_samp({v})', 'std')}, {rnd(f'min({v})', 'min')}, "
            f"{rnd(f'quantile_cont({v}, 0.25)', 'p25')}, {rnd(f'quantile_cont({v}, 0.5)', 'p50')}, "
            f"{rnd(f'quantile_cont({v}, 0.75)', 'p75')}, {rnd(f'max({v})', 'max')} FROM pb")
    return " UNION ALL ".join(parts)


_FINAL = list(FINAL_COLS)
_FINAL_PLAIN = {"loan_id", "booking_year", "vintage_index", "num_inquiries_12m", "term_months", "default_12m", "stage"}
_FINAL_SELECT = ", ".join(
    "strftime(booking_month, '%Y-%m') AS booking_month" if c == "booking_month" else c if c in _FINAL_PLAIN else rnd(c, c)
    for c in _FINAL)

_STD_SELECT = (f"SELECT loan_id, basel_grade, {rnd('basel_rw', 'basel_rw')}, "
               f"{rnd('rwa_standardised', 'rwa_standardised')}, {rnd('capital_required_std', 'capital_required_std')} "
               f"FROM std")

_SPLIT_KEY = f"CAST(('0x' || substr(md5(CAST(loan_id AS VARCHAR) || ':{SPLIT_SALT}'), 1, 13)) AS BIGINT)"

# the test rows of a class: its share of ceil(TEST_SIZE * n), by largest remainder, smallest keys first
cte("sizes", ["pa"], f"""
  SELECT default_12m, count(*) AS n_class, sum(count(*)) OVER () AS n,
         ceil({d(TEST_SIZE)} * sum(count(*)) OVER () - 1e-9) AS n_test FROM pa GROUP BY default_12m""")

cte("parts", ["sizes"], """
  SELECT *, floor(n_class * n_test / n) AS low, n_class * n_test / n - floor(n_class * n_test / n) AS rest FROM sizes""")

cte("quota", ["parts"], """
  SELECT default_12m, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, default_12m) <= n_test - sum(low) OVER ()
                                 THEN 1 ELSE 0 END AS quota FROM parts""")

cte("split", ["pa", "quota"], f"""
  SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY p.default_12m ORDER BY {_SPLIT_KEY}, loan_id) <= quota
                   THEN 'test' ELSE 'train' END AS split
  FROM pa p JOIN quota USING (default_12m)""")

cte("champion", ["split"], f"""
  SELECT loan_id, default_12m, split, {sigmoid(score(CHAMPION_INTERCEPT, CHAMPION_TERMS, {}), CHAMPION_BOUND)} AS pd_model
  FROM split""")


# ---- the logistic fit: Newton steps written out, 11 equations each, solved by elimination ----
# powers of ten that the equations are solved in; the solution does not depend on them
_FIT_UNITS = (1.0, 1e2, 1e5, 1e3, 1e1, 1.0, 1.0, 1e1, 1e1, 1e1, 1e1)
_FIT_STEPS = 9


def _newton_ctes() -> str:
    """``fit0`` .. ``fit<_FIT_STEPS>``: one row w0..w10 each, in units of ``_FIT_UNITS``, the intercept first."""
    k = len(FEATURES) + 1
    ridge = [0.0] + [1.0 / u**2 for u in _FIT_UNITS[1:]]
    x = [d(1.0)] + [f"x{i}" for i in range(1, k)]
    cols = ", ".join(f"CAST({f} AS DOUBLE) / {d(u)} AS x{i}" for i, (f, u) in enumerate(zip(FEATURES, _FIT_UNITS[1:]), 1))
    out = [f"tr AS MATERIALIZED (SELECT CAST(default_12m AS DOUBLE) AS y, {cols} FROM split WHERE split = 'train')",
           "fit0 AS (SELECT " + ", ".join(f"{d(0.0)} AS w{i}" for i in range(k)) + ")"]
    for s in range(1, _FIT_STEPS + 1):
        z = clip(" + ".join(f"w{i} * {x[i]}" for i in range(k)), -LOGIT_BOUND, LOGIT_BOUND)
        sums = [f"any_value(w{i}) AS w{i}" for i in range(k)]
        sums += [f"sum((p - y) * {x[i]}) + {d(ridge[i])} * any_value(w{i}) AS b{i}" for i in range(k)]
        sums += [f"sum(p * ({d(1.0)} - p) * {x[i]} * {x[j]}) + {d(ridge[i] if i == j else 0.0)} AS a{i}_{j}"
                 for i in range(k) for j in range(i, k)]
        out.append(f"p{s} AS (SELECT *, {d(1.0)} / ({d(1.0)} + exp(-({z}))) AS p FROM tr CROSS JOIN fit{s - 1})")
        out.append(f"e{s}_0 AS MATERIALIZED (SELECT {', '.join(sums)} FROM p{s})")
        for m in range(k - 1):  # eliminate unknown m from the equations below it
            new = [f"b{i} - a{m}_{i} * b{m} / a{m}_{m} AS b{i}" for i in range(m + 1, k)]
            new += [f"a{i}_{j} - a{m}_{i} * a{m}_{j} / a{m}_{m} AS a{i}_{j}" for i in range(m + 1, k) for j in range(i, k)]
            out.append(f"e{s}_{m + 1} AS MATERIALIZED (SELECT * REPLACE ({', '.join(new)}) FROM e{s}_{m})")
        for i in range(k - 1, -1, -1):  # back substitution: b becomes the step
            rest = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, k))
            src = f"e{s}_{k - 1}" if i == k - 1 else f"s{s}_{i + 1}"
            out.append(f"s{s}_{i} AS MATERIALIZED (SELECT * REPLACE ((b{i}{rest}) / a{i}_{i} AS b{i}) FROM {src})")
        out.append(f"fit{s} AS MATERIALIZED (SELECT {', '.join(f'w{i} - b{i} AS w{i}' for i in range(k))} FROM s{s}_0)")
    return ",\n".join(out)


def _fit_sql(select: str) -> str:
    return with_ctes("split").rstrip() + ",\n" + _newton_ctes() + "\n" + select


def _metrics_sql(scored: str) -> str:
    """``n_train, n_test, auc, brier`` of ``scored(default_12m, split, pd_model)``."""
    return (
        f"SELECT n_train, n_test, {rnd('auc', 'auc')}, {rnd('brier', 'brier')} FROM ("
        "SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test, "
        f"avg((pd_model - default_12m) * (pd_model - default_12m)) FILTER (split = 'test') AS brier FROM {scored}) "
        "CROSS JOIN (SELECT sum(pos * (coalesce(before, 0) + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc "
        "FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY pd_model ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before "
        f"FROM (SELECT pd_model, sum(default_12m) AS pos, sum(1 - default_12m) AS neg FROM {scored} WHERE split = 'test' "
        "GROUP BY pd_model)))")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    tape_doubles = ["age", "annual_income", "credit_score", "employment_years", "dti_ratio", "utilization_ratio",
                    "loan_amount", "interest_rate"]
    q["loan_tape"] = sql(["tape"], "SELECT loan_id, customer_id, booking_month, booking_year, vintage_index, "
                         + ", ".join(rnd(c, c) for c in tape_doubles)
                         + ", num_inquiries_12m, term_months FROM tape")
    q["loan_tape_bucketed"] = q["loan_tape"]
    q["macro_path"] = sql(["mac"], f"SELECT month, {rnd('unemployment_rate', 'unemployment_rate')}, "
                          f"{rnd('gdp_growth', 'gdp_growth')}, {rnd('house_price_index', 'house_price_index')} FROM mac")
    q["macro_at_booking"] = sql(["tapem"], f"SELECT loan_id, booking_month, {rnd('booking_unemp', 'booking_unemp')}, "
                                f"{rnd('booking_gdp_growth', 'booking_gdp_growth')}, "
                                f"{rnd('booking_hpi', 'booking_hpi')} FROM tapem")
    q["vintage_index"] = sql(["tape"], "SELECT loan_id, booking_year, vintage_index FROM tape")
    q["pit_pd"] = sql(["pa"], f"SELECT loan_id, {rnd('pd_12m', 'pd_12m')}, default_12m FROM pa")
    q["origination_pd"] = sql(["pb"], f"SELECT loan_id, {rnd('pd_12m_origination', 'pd_12m_origination')} FROM pb")
    q["current_pd"] = sql(["pb"], f"SELECT loan_id, {rnd('pd_12m_origination', 'pd_12m_origination')}, "
                          f"{rnd('pd_12m', 'pd_12m')}, default_12m FROM pb")
    q["pd_ratio_flags"] = sql(["pb"], f"SELECT loan_id, {rnd('pd_ratio', 'pd_ratio')}, dpd_30_plus, dpd_90_plus FROM pb")
    q["lgd_ead"] = sql(["pa"], f"SELECT loan_id, {rnd('lgd', 'lgd')}, {rnd('ead', 'ead')} FROM pa")
    q["ecl_term"] = sql(["pa"], f"SELECT loan_id, {rnd('realized_loss_12m', 'realized_loss_12m')}, "
                        f"{rnd('ecl_12m', 'ecl_12m')}, {rnd('pd_lifetime', 'pd_lifetime')}, "
                        f"{rnd('ecl_lifetime', 'ecl_lifetime')} FROM pa")
    q["ecl_multiplier"] = sql(["pb"], f"SELECT loan_id, {rnd('ead', 'ead')}, {rnd('lgd', 'lgd')}, "
                              f"{rnd('ecl_12m', 'ecl_12m')}, {rnd('ecl_lifetime', 'ecl_lifetime')} FROM pb")
    q["realized_loss"] = sql(["pa"], f"SELECT booking_year, count(*) AS loans, CAST(sum(default_12m) AS BIGINT) "
                             f"AS defaults, {rnd('sum(realized_loss_12m)', 'realized_loss_12m')} FROM pa "
                             f"GROUP BY booking_year")
    q["stage_pd_bands"] = sql(["pa"], f"SELECT loan_id, {rnd('pd_12m', 'pd_12m')}, stage FROM pa")
    q["stage_sicr"] = sql(["pb"], "SELECT loan_id, stage_ifrs9 FROM pb")
    q["stage_sicr_params"] = sql(["pb"], "SELECT loan_id, stage_alt AS stage_ifrs9 FROM pb")
    q["stage3_rate"] = sql(["pb"], f"SELECT {rnd('avg(CAST(stage_ifrs9 = 3 AS DOUBLE))', 'stage3_rate')} FROM pb")
    kpis = ("CAST(count(*) AS DOUBLE)", "coalesce(sum(ead), 0.0)", "coalesce(sum(ecl_12m), 0.0)",
            "coalesce(sum(ecl_lifetime), 0.0)", "avg(CAST(default_12m AS DOUBLE))")
    q["portfolio_kpis"] = sql(["pa"], " UNION ALL ".join(
        f"SELECT '{label}' AS kpi, (round({x}, {RATIO_PLACES if label == KPI_LABELS[4] else MONEY_PLACES}) + {d(0.0)}) "
        f"AS value FROM pa" for label, x in zip(KPI_LABELS, kpis, strict=True)))
    q["vintage_stats"] = sql(["pa"], f"SELECT vintage_index, {rnd('avg(pd_12m)', 'avg_pd')}, "
                             f"{rnd('avg(CAST(default_12m AS DOUBLE))', 'default_rate')}, "
                             f"{rnd('avg(ecl_12m)', 'ecl_12m')}, {rnd('avg(booking_unemp)', 'booking_unemp')} "
                             f"FROM pa WHERE vintage_index IS NOT NULL GROUP BY vintage_index")
    q["stage_mix"] = sql(["pa"], _stage_mix_sql("pa", "stage", "stage"))
    q["describe_pd"] = sql(["pb"], _describe_sql())
    q["tape_head"] = sql(["pa"], f"SELECT {_FINAL_SELECT} FROM pa ORDER BY loan_id LIMIT 5")
    q["tape_shape"] = sql(["pa"], f"SELECT count(*) AS rows, {len(_FINAL)} AS columns FROM pa")
    q["stage_ecl"] = sql(["pb"], (
        f"SELECT stage_ifrs9, count(loan_id) AS loans, {rnd('sum(ead)', 'ead')}, {rnd('avg(pd_12m)', 'avg_pd')}, "
        f"{rnd('avg(lgd)', 'avg_lgd')}, {rnd('sum(ecl_12m)', 'ecl_12m')}, {rnd('sum(ecl_lifetime)', 'ecl_lifetime')}, "
        f"{rnd('CASE WHEN stage_ifrs9 = 1 THEN sum(ecl_12m) ELSE sum(ecl_lifetime) END', 'reported_loss_allowance')} "
        f"FROM pb WHERE stage_ifrs9 IS NOT NULL GROUP BY stage_ifrs9"))
    q["sql_stage_sicr_params"], q["sql_stage_ecl"] = q["stage_sicr_params"], q["stage_ecl"]
    q["total_allowance"] = sql(["pb"], (
        f"SELECT {rnd('coalesce(sum(CASE WHEN stage_ifrs9 = 1 THEN ecl_12m ELSE ecl_lifetime END), 0.0)', 'total_loss_allowance')} "
        f"FROM pb WHERE stage_ifrs9 IS NOT NULL"))
    q["stress_additive"] = sql(["pa"], f"SELECT loan_id, {rnd('pd_12m_stressed', 'pd_12m_stressed')}, "
                               f"{rnd('ecl_12m_stressed', 'ecl_12m_stressed')} FROM pa")
    q["stress_totals"] = sql(["pa"], f"SELECT {rnd('sum(ecl_12m)', 'base_ecl')}, "
                             f"{rnd('sum(ecl_12m_stressed)', 'stressed_ecl')}, "
                             f"{rnd('sum(ecl_12m_stressed) - sum(ecl_12m)', 'uplift')} FROM pa")
    scenarios = []
    for name, (u, g) in stress.SCENARIOS.items():
        z = sigmoid(score(risk.PIT_INTERCEPT, risk.PIT_TERMS, {
            "unemployment_rate": f"(s.unemployment_rate + {d(u)})", "gdp_growth": f"(s.gdp_growth + {d(g)})"}))
        scenarios.append(
            f"SELECT '{name}' AS scenario, {rnd('sum(ecl_12m)', 'base_ecl')}, {rnd(f'sum(ead * lgd * {z})', 'stressed_ecl')}, "
            f"{rnd(f'sum(ead * lgd * {z}) - sum(ecl_12m)', 'uplift')} FROM pa CROSS JOIN snap s")
    q["stress_scenarios"] = sql(["pa", "snap"], " UNION ALL ".join(scenarios))
    q["stress_multiplier"] = sql(["pbs"], f"SELECT loan_id, {rnd('pd_12m_stressed', 'pd_12m_stressed')}, "
                                 f"{rnd('ecl_12m_stressed', 'ecl_12m_stressed')}, "
                                 f"{rnd('pd_ratio_stressed', 'pd_ratio_stressed')}, stage_ifrs9_stressed FROM pbs")
    q["stage_mix_stressed"] = sql(["pbs"], (
        "SELECT scenario, stage_ifrs9, count(*) AS loans, "
        f"{rnd('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY scenario)', 'share')} FROM ("
        "SELECT 'base' AS scenario, stage_ifrs9 FROM pbs UNION ALL "
        "SELECT 'stressed' AS scenario, stage_ifrs9_stressed AS stage_ifrs9 FROM pbs) "
        "WHERE stage_ifrs9 IS NOT NULL GROUP BY scenario, stage_ifrs9"))
    q["stage_ecl_stressed"] = sql(["pbs"], (
        f"SELECT stage_ifrs9_stressed AS stage_ifrs9, {rnd('sum(ead)', 'ead')}, "
        f"{rnd('sum(ecl_12m_stressed)', 'ecl_12m_stressed')}, {rnd('sum(ecl_lifetime)', 'ecl_lifetime')}, "
        f"{rnd('CASE WHEN stage_ifrs9_stressed = 1 THEN sum(ecl_12m_stressed) ELSE sum(ecl_lifetime) END', 'reported_loss_allowance_stressed')} "
        f"FROM pbs WHERE stage_ifrs9_stressed IS NOT NULL GROUP BY stage_ifrs9_stressed"))
    base = "coalesce(sum(CASE WHEN stage_ifrs9 = 1 THEN ecl_12m ELSE ecl_lifetime END), 0.0)"
    strs = "coalesce(sum(CASE WHEN stage_ifrs9_stressed = 1 THEN ecl_12m_stressed ELSE ecl_lifetime END), 0.0)"
    q["allowance_increase"] = sql(["pbs"], (
        f"SELECT {rnd(base, 'total_loss_allowance')}, {rnd(strs, 'stressed_loss_allowance')}, "
        f"{rnd(f'(({strs}) / ({base}) - 1.0) * 100.0', 'allowance_increase_pct')} FROM pbs"))
    q["book_stage_ecl"] = q["stage_ecl_from_states"] = q["stage_ecl"]
    q["allowance_from_states"] = q["allowance_increase"]
    q["stage_migration"] = sql(["pbs", "cal"], (
        "SELECT coalesce(CAST(f.stage AS VARCHAR), 'new') AS stage_from, coalesce(CAST(t.stage AS VARCHAR), 'closed') AS stage_to, "
        f"count(*) AS loans, {rnd('coalesce(sum(f.allowance), 0.0)', 'allowance_from')}, "
        f"{rnd('coalesce(sum(t.allowance), 0.0)', 'allowance_to')} FROM ("
        "SELECT loan_id, stage_ifrs9 AS stage, CASE WHEN stage_ifrs9 = 1 THEN ecl_12m ELSE ecl_lifetime END AS allowance "
        "FROM pbs, cal WHERE booking_month < date_trunc('year', last_month)) f FULL JOIN ("
        "SELECT loan_id, stage_ifrs9_stressed AS stage, "
        "CASE WHEN stage_ifrs9_stressed = 1 THEN ecl_12m_stressed ELSE ecl_lifetime END AS allowance "
        "FROM pbs, cal WHERE booking_month + to_months(term_months) > last_month) t USING (loan_id) GROUP BY 1, 2"))
    q["vintage_stats_selected"] = sql(["pa", "mac"], f"SELECT vintage_index, {rnd('avg(pd_12m)', 'avg_pd')}, "
                             f"{rnd('avg(CAST(default_12m AS DOUBLE))', 'default_rate')}, "
                             f"{rnd('avg(ecl_12m)', 'ecl_12m')}, {rnd('avg(booking_unemp)', 'booking_unemp')} "
                             "FROM pa WHERE booking_year IN (SELECT year(month) FROM mac GROUP BY 1 "
                             "HAVING avg(unemployment_rate) > (SELECT avg(unemployment_rate) FROM mac)) GROUP BY vintage_index")
    q["basel_standardised"] = sql(["std"], _STD_SELECT)
    q["basel_grade_band_join"] = sql(["std"], _STD_SELECT)
    q["income_band_lookup"] = sql(["tape"], (
        f"SELECT loan_id, {rnd('loan_amount', 'loan_amount')}, band, {rnd('lo', 'band_start')} FROM tape ASOF LEFT JOIN ("
        "SELECT round(c_acctbal * 12.0, 2) AS lo, min(c_custkey) AS band FROM customer GROUP BY 1) b ON tape.loan_amount >= b.lo"))
    q["basel_std_totals"] = sql(["std"], f"SELECT {rnd('coalesce(sum(rwa_standardised), 0.0)', 'portfolio_rwa')}, "
                                f"{rnd('coalesce(sum(capital_required_std), 0.0)', 'portfolio_capital')} FROM std")
    q["norm_functions"] = sql(["z"], f"SELECT loan_id, {rnd('pd_12m', 'pd_12m')}, {rnd('z_pd', 'z_pd')}, "
                              f"{rnd(cdf_sql('z_pd'), 'cdf_z')} FROM z")
    q["irb_correlation"] = sql(["irb1"], f"SELECT loan_id, {rnd('rho', 'irb_rho')}, {rnd('bb', 'maturity_b')} FROM irb1")
    q["irb_capital"] = sql(["irb"], (
        f"SELECT loan_id, {rnd('effective_maturity_years', 'effective_maturity_years')}, "
        f"{rnd('irb_cap_ratio_per_ead', 'irb_cap_ratio_per_ead')}, {rnd('rwa_irb', 'rwa_irb')}, "
        f"{rnd('capital_required_irb', 'capital_required_irb')} FROM irb"))
    q["irb_totals"] = sql(["irb"], (
        f"SELECT {rnd('coalesce(sum(rwa_irb), 0.0)', 'total_rwa_irb')}, "
        f"{rnd('coalesce(sum(capital_required_irb), 0.0)', 'total_capital_irb')}, "
        f"{rnd('avg(irb_cap_ratio_per_ead)', 'avg_irb_k')}, {rnd('min(pd_12m)', 'min_pd')}, "
        f"{rnd('max(pd_12m)', 'max_pd')} FROM irb"))
    q["irb_by_stage"] = sql(["irb"], (
        f"SELECT stage_ifrs9, {rnd('coalesce(sum(rwa_irb), 0.0)', 'rwa_irb')}, "
        f"{rnd('coalesce(sum(capital_required_irb), 0.0)', 'capital_required_irb')}, {rnd('avg(pd_12m)', 'pd_12m')}, "
        f"{rnd('avg(irb_cap_ratio_per_ead)', 'irb_cap_ratio_per_ead')} FROM irb "
        f"WHERE stage_ifrs9 IS NOT NULL GROUP BY stage_ifrs9"))
    q["auc"] = sql(["pb"], (
        "SELECT " + rnd("sum(pos * (coalesce(neg_before, 0) + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * "
                        "CAST(sum(neg) AS DOUBLE))", "auc") + " FROM ("
        "SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
        "AS neg_before FROM (SELECT pd_12m AS s, sum(default_12m) AS pos, sum(1 - default_12m) AS neg "
        "FROM pb WHERE pd_12m IS NOT NULL AND default_12m IS NOT NULL GROUP BY pd_12m))"))
    q["brier"] = sql(["pb"], f"SELECT {rnd('avg((pd_12m - CAST(default_12m AS DOUBLE)) * (pd_12m - CAST(default_12m AS DOUBLE)))', 'brier')} FROM pb")
    q["stratified_split"] = sql(["split"], "SELECT default_12m, split, count(*) AS loans FROM split GROUP BY 1, 2")
    q["champion_scores"] = sql(["champion"], f"SELECT loan_id, split, {rnd('pd_model', 'pd_model')} FROM champion")
    q["champion_metrics"] = sql(["champion"], _metrics_sql("champion"))
    last = f"fit{_FIT_STEPS}"
    own = ["w0", *(f"w{i} / {d(u)}" for i, u in enumerate(_FIT_UNITS[1:], 1))]
    q["pd_coefficients"] = _fit_sql(" UNION ALL ".join(
        f"SELECT '{f}' AS feature, {rnd(x, 'coefficient')} FROM {last}" for f, x in zip(("intercept", *FEATURES), own, strict=True)))
    z = " + ".join(f"{x} * CAST({f} AS DOUBLE)" if f else x for x, f in zip(own, ("", *FEATURES)))
    scored = f"(SELECT default_12m, split, {sigmoid(z, LOGIT_BOUND)} AS pd_model FROM split CROSS JOIN {last})"
    q["pd_backtest"] = _fit_sql(_metrics_sql(scored))
    q["tape_reconciliation"] = (
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS booking_year, count(*) AS orders, count(c_custkey) AS loans, "
        "count(*) - count(c_custkey) AS no_customer, count(*) - count(o_orderdate) AS no_date "
        "FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1")
    q["final_table"] = sql(["pa"], f"SELECT {_FINAL_SELECT} FROM pa")
    q["direct_mapping"] = ("SELECT CAST(o_orderkey AS BIGINT) AS loan_id, CAST(o_custkey AS BIGINT) AS customer_id, "
                           f"{rnd('CAST(o_totalprice AS DOUBLE)', 'order_value')}, "
                           "CAST(o_orderdate AS DATE) AS booking_date, "
                           "CAST(o_orderstatus AS VARCHAR) AS contract_status FROM orders")
    q["pk_check"] = (
        "SELECT 'orders' AS table_name, 'o_orderkey' AS pk_columns, CAST(sum(n) AS BIGINT) AS rows, "
        "CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_key_rows, "
        "CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END), 0) AS BIGINT) AS duplicate_keys "
        "FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY o_orderkey) UNION ALL "
        "SELECT 'customer', 'c_custkey', CAST(sum(n) AS BIGINT), "
        "CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT), "
        "CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END), 0) AS BIGINT) "
        "FROM (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY c_custkey)")
    return q
