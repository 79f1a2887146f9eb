"""Standard normal quantile and CDF as native Column expressions.

Spark has no ``erf``; both functions are rational approximations evaluated with
built-in arithmetic, so they stay JVM-side and vectorise under codegen.

* quantile: Wichura (1988), Algorithm AS 241 "PPND16", relative accuracy ~1e-16.
* CDF: Hart (1968) double-precision rational form as published by West (2005),
  "Better approximations to cumulative normal functions", accuracy ~1e-15.

For heavy use (IRB capital) call :func:`with_norm_ppf`, which stages the
intermediate values as columns so each generated method stays small enough for
the JIT (one nested expression compiles to >8 KB of bytecode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import ColumnOrName, col_, pushdown_barrier

# ---- fixed values: AS 241 (PPND16) coefficients, lowest order first ----------
PPND16_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
            1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
            3.3430575583588128105e4, 2.5090809287301226727e3]
PPND16_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
            2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
            5.2264952788528545610e3]
PPND16_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
            3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
            2.27238449892691845833e-2, 7.74545014278341407640e-4]
PPND16_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
            1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
            1.05075007164441684324e-9]
PPND16_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
            2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
            2.71155556874348757815e-5, 2.01033439929228813265e-7]
PPND16_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
            7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
            2.04426310338993978564e-15]
# ---- fixed values: Hart/West double-precision CDF coefficients, highest order first ----
CDF_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
           112.079291497871, 221.213596169931, 220.206867912376]
CDF_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
           296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
CDF_SPLIT = 7.07106781186547
CDF_CUTOFF = 37.0
SQRT_2PI = 2.506628274631
# Φ⁻¹(0.999), used by the IRB formula
Z_999 = 3.090232306167813


def horner(x: Column, coefs_low_first: Sequence[float]) -> Column:
    """Σ c_i x^i evaluated as (((c_n x + c_{n-1}) x + …) x + c_0)."""
    acc = F.lit(float(coefs_low_first[-1]))
    for c in reversed(coefs_low_first[:-1]):
        acc = acc * x + F.lit(float(c))
    return acc


def _ppf_from_parts(q: Column, r_central: Column, r_tail: Column) -> Column:
    central = q * horner(r_central, PPND16_A) / horner(r_central, PPND16_B)
    t1 = r_tail - F.lit(1.6)
    t2 = r_tail - F.lit(5.0)
    tail_mag = (F.when(r_tail <= F.lit(5.0), horner(t1, PPND16_C) / horner(t1, PPND16_D))
                .otherwise(horner(t2, PPND16_E) / horner(t2, PPND16_F)))
    sign = F.when(q < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(F.abs(q) <= F.lit(0.425), central).otherwise(sign * tail_mag)


def _tail_r(p: Column, q: Column) -> Column:
    small = F.when(q < 0, p).otherwise(F.lit(1.0) - p)
    return F.sqrt(-F.ln(small))


def norm_ppf(p: ColumnOrName) -> Column:
    """Φ⁻¹(p) for p in (0, 1); NULL outside (ln of 0 is NULL in Spark)."""
    pc = col_(p)
    q = pc - F.lit(0.5)
    r_central = F.lit(0.180625) - q * q
    return _ppf_from_parts(q, r_central, _tail_r(pc, q))


def with_norm_ppf(df: DataFrame, p_col: str, out_col: str, prefix: str = "_ppf", barrier: bool = True,
                  assume_valid: bool = False, deep_tail: bool = True) -> DataFrame:
    """Staged Φ⁻¹ for heavy use; NULL for a NULL/NaN p or p outside (0, 1).

    Every intermediate column is referenced more than once by the next step, so
    Catalyst's CollapseProject keeps the steps apart, and the arithmetic runs on
    non-nullable values (invalid inputs are masked once at the end), which keeps
    the generated code small enough for the JIT. ``barrier`` stops later filters
    from being pushed into the staged steps (see ``core.pushdown_barrier``).
    ``assume_valid`` skips the input mask when the caller guarantees a non-null p
    inside (0, 1); ``deep_tail=False`` drops the r > 5 branch, valid when the caller
    guarantees min(p, 1 − p) ≥ e^(−25) ≈ 1.4e-11.
    """
    from . import sqltext as X
    from .core import with_exprs

    ok, pv, q, rc, rt, t1, t2 = (f"{prefix}_{n}" for n in ("ok", "p", "q", "rc", "rt", "t1", "t2"))
    p = X.ident(p_col)
    if assume_valid:
        valid = "true"
    else:
        df = with_exprs(df, {ok: f"({p} IS NOT NULL AND NOT isnan({p}) AND {p} > 0 AND {p} < 1)"})
        valid = ok
    df = with_exprs(df, {pv: p if assume_valid else f"CASE WHEN {valid} THEN {p} ELSE {X.num(0.5)} END"})
    df = with_exprs(df, {q: f"{pv} - {X.num(0.5)}"})
    df = with_exprs(df, {
        rc: f"{X.num(0.180625)} - {q} * {q}",
        rt: f"coalesce(sqrt(-ln(CASE WHEN {q} < 0 THEN {pv} ELSE {X.num(1.0)} - {pv} END)), {X.num(0.0)})",
    })
    df = with_exprs(df, {t1: f"{rt} - {X.num(1.6)}", t2: f"{rt} - {X.num(5.0)}"})
    central = f"{q} * {X.horner_low(rc, PPND16_A)} / {X.horner_low(rc, PPND16_B)}"
    near_tail = f"{X.horner_low(t1, PPND16_C)} / {X.horner_low(t1, PPND16_D)}"
    if deep_tail:
        tail_mag = (f"(CASE WHEN {rt} <= {X.num(5.0)} THEN {near_tail} "
                    f"ELSE {X.horner_low(t2, PPND16_E)} / {X.horner_low(t2, PPND16_F)} END)")
    else:
        tail_mag = f"({near_tail})"
    # the sign as a factor, so each polynomial appears once in the generated code
    sign = f"(CASE WHEN {q} < 0 THEN {X.num(-1.0)} ELSE {X.num(1.0)} END)"
    core = f"(CASE WHEN abs({q}) <= {X.num(0.425)} THEN {central} ELSE {sign} * {tail_mag} END)"
    out = core if assume_valid else f"CASE WHEN {valid} THEN {core} END"
    df = with_exprs(df, {out_col: out}).drop(pv, q, rc, rt, t1, t2, *([] if assume_valid else [ok]))
    return pushdown_barrier(df, "norm_ppf") if barrier else df


def _horner_high_first(x: Column, coefs: Sequence[float]) -> Column:
    acc = F.lit(float(coefs[0]))
    for c in coefs[1:]:
        acc = acc * x + F.lit(float(c))
    return acc


def norm_cdf(x: ColumnOrName) -> Column:
    """Φ(x) (Hart/West); exact 0/1 beyond |x| > 37."""
    xc = col_(x)
    a = F.abs(xc)
    e = F.exp(-(a * a) / F.lit(2.0))
    near = e * _horner_high_first(a, CDF_NUM) / _horner_high_first(a, CDF_DEN)
    cf = a + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = a + F.lit(k) / cf
    far = e / cf / F.lit(SQRT_2PI)
    lower = (F.when(a > F.lit(CDF_CUTOFF), F.lit(0.0))
             .when(a < F.lit(CDF_SPLIT), near)
             .otherwise(far))
    return F.when(xc > 0, F.lit(1.0) - lower).otherwise(lower)


def with_norm_cdf(df: DataFrame, x_col: str, out_col: str, prefix: str = "_cdf", barrier: bool = True,
                  assume_valid: bool = False, near_only: bool = False) -> DataFrame:
    """Staged Φ (see :func:`with_norm_ppf` for why the steps are columns); NULL stays NULL.

    ``assume_valid`` skips the NULL handling when the caller guarantees a non-null x;
    ``near_only`` drops the |x| ≥ 7.07 branch when the caller guarantees |x| < 7.07.
    """
    from . import sqltext as X
    from .core import with_exprs

    xv, a, e, lo = (f"{prefix}_{n}" for n in ("x", "a", "e", "lower"))
    x = X.ident(x_col)
    df = with_exprs(df, {xv: x if assume_valid else f"coalesce({x}, {X.num(0.0)})"})
    df = with_exprs(df, {a: f"abs({xv})"})
    df = with_exprs(df, {e: f"exp(-({a} * {a}) / {X.num(2.0)})"})
    near = f"{e} * {X.horner_high(a, CDF_NUM)} / {X.horner_high(a, CDF_DEN)}"
    cf = f"({a} + {X.num(0.65)})"
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = f"({a} + {X.num(k)} / {cf})"
    far = f"{e} / {cf} / {X.num(SQRT_2PI)}"
    if near_only:
        df = with_exprs(df, {lo: near})
    else:
        df = with_exprs(df, {lo: f"(CASE WHEN {a} > {X.num(CDF_CUTOFF)} THEN {X.num(0.0)} "
                                f"WHEN {a} < {X.num(CDF_SPLIT)} THEN {near} ELSE {far} END)"})
    sign_case = f"CASE WHEN {xv} > 0 THEN {X.num(1.0)} - {lo} ELSE {lo} END"
    out = sign_case if assume_valid else f"CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE) ELSE {sign_case} END"
    df = with_exprs(df, {out_col: out}).drop(xv, a, e, lo)
    return pushdown_barrier(df, "norm_cdf") if barrier else df
