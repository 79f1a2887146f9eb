"""Scalar Column helpers: clipping, clamped sigmoid, zero-safe ratios, scorecards.

Everything here returns a ``pyspark.sql.Column`` built from built-in functions,
so it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """``np.clip`` semantics: NULL and NaN stay NULL (not pinned to a bound).

    ``least``/``greatest`` skip NULLs and order NaN above every number, so the
    guard keeps a missing value missing instead of turning it into a bound.
    """
    x = col_(c)
    out = x
    if lo is not None:
        out = F.greatest(out, lit_(lo))
    if hi is not None:
        out = F.least(out, lit_(hi))
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double")).otherwise(out)


def nan_to_null(c: ColumnOrName) -> Column:
    x = col_(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def sigmoid(z: ColumnOrName, bound: float = 10.0) -> Column:
    """Logistic function of a logit clamped to [-bound, bound]."""
    zc = clip(z, -bound, bound)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-zc))


def zero_safe(c: ColumnOrName, replacement: float = 1e-6) -> Column:
    """Replace an exact zero denominator (pandas ``.replace(0, eps)``)."""
    x = col_(c)
    return F.when(x == 0, F.lit(replacement)).otherwise(x)


def ratio(num: ColumnOrName, den: ColumnOrName, zero_replacement: float = 1e-6) -> Column:
    return col_(num) / zero_safe(den, zero_replacement)


def flag(cond: Column) -> Column:
    """Boolean → 0/1 int, with NULL conditions counted as false (NumPy mask)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def trunc_toward_zero(c: ColumnOrName) -> Column:
    x = col_(c)
    return F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")


@dataclass(frozen=True)
class Term:
    """One scorecard term ``coef * (column - center)``; a literal term has no column."""

    coef: float
    column: str | None = None
    center: float = 0.0
    cast: str = "double"


def linear_score(intercept: float, terms: Iterable[Term], values: Mapping[str, float] | None = None) -> Column:
    """``intercept + Σ coef·(x − center)`` as one left-to-right sum.

    ``values`` supplies scalar inputs (for example a macro snapshot) for terms whose
    ``column`` names a key there; those become literals Catalyst can fold.
    """
    values = values or {}
    acc: Column = F.lit(float(intercept))
    for t in terms:
        if t.column is not None and t.column in values:
            x = F.lit(float(values[t.column]))
        elif t.column is not None:
            x = F.col(t.column).cast(t.cast)
        else:
            x = F.lit(1.0)
        if t.center:
            x = x - F.lit(float(t.center))
        acc = acc + F.lit(float(t.coef)) * x
    return acc


def require_columns(df, *names: str) -> None:
    """Fail early, naming what is missing, instead of deep inside the plan."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")


def round_half_even(c: ColumnOrName, scale: int) -> Column:
    """pandas ``.round`` is half-to-even; use at the presentation edge only."""
    return F.bround(col_(c), scale)


def pushdown_barrier(df, tag: str):
    """Stop later filters from being pushed into a chain of staged projections.

    Staged intermediates (see ``functions.gaussian``) are referenced many times
    each; pushing a filter through them would inline every alias at every level
    and multiply the predicate's size until the optimizer overflows. A
    ``CollectMetrics`` node (``observe``, here a row count) is not something
    predicates are pushed through, so the filter stays above it.
    """
    return df.observe(f"{tag}_{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"))


def with_exprs(df, exprs: Mapping[str, str]):
    """Add or replace columns from Spark SQL expression text (one JVM call per column)."""
    return df.withColumns({name: F.expr(text) for name, text in exprs.items()})
