"""Spark SQL expression text for the library's formulas.

Building a formula as a tree of ``Column`` objects costs one Python→JVM call per
node (thousands for a scorecard plus normal quantile). The same expression as
SQL text is parsed in one call by ``F.expr`` / ``selectExpr`` and yields the
identical Catalyst expression, so the operators compose text and hand it to
Spark once per output column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

TWO_32 = 4294967296.0


def num(x: float) -> str:
    """A DOUBLE literal (``0.5D``); exact round trip of the Python float."""
    return f"{float(x)!r}D"


def ident(name: str) -> str:
    return name if name.replace("_", "").isalnum() and not name[0].isdigit() else f"`{name}`"


def clip(x: str, lo=None, hi=None) -> str:
    """NULL/NaN stay NULL; otherwise ``least(greatest(x, lo), hi)``."""
    inner = x
    if lo is not None:
        inner = f"greatest({inner}, {num(lo)})"
    if hi is not None:
        inner = f"least({inner}, {num(hi)})"
    return f"(CASE WHEN ({x}) IS NULL OR isnan({x}) THEN CAST(NULL AS DOUBLE) ELSE {inner} END)"


def sigmoid(z: str, bound: float) -> str:
    return f"({num(1.0)} / ({num(1.0)} + exp(-{clip(z, -bound, bound)})))"


def linear_score(intercept: float, terms, values: Mapping[str, float] | None = None) -> str:
    """``intercept + Σ coef·(x − center)`` summed left to right (terms: ``Term`` objects)."""
    values = values or {}
    acc = num(intercept)
    for t in terms:
        if t.column is not None and t.column in values:
            x = num(values[t.column])
        elif t.column is not None:
            x = f"CAST({ident(t.column)} AS DOUBLE)"
        else:
            x = num(1.0)
        if t.center:
            x = f"({x} - {num(t.center)})"
        acc = f"({acc} + {num(t.coef)} * {x})"
    return acc


def _chunk(key: str, salt) -> str:
    group, part = (salt // 4, salt % 4) if isinstance(salt, int) else (salt, 0)
    return f"substring(md5(concat(CAST({key} AS STRING), ':{group}')), {1 + 8 * part}, 8)"


def uniform(key: str, salt) -> str:
    """Keyed uniform draw (see ``functions.draws``)."""
    return f"(CAST(CAST(conv({_chunk(key, salt)}, 16, 10) AS BIGINT) AS DOUBLE) / {num(TWO_32)})"


def uniform_between(key: str, salt, lo: float, width: float) -> str:
    return f"({num(lo)} + {num(width)} * {uniform(key, salt)})"


def choice(key: str, salt, values: Sequence, weights: Sequence[float]) -> str:
    total = float(sum(weights))
    u = uniform(key, salt)
    acc, parts = 0.0, []
    for v, w in zip(values[:-1], weights[:-1]):
        acc += float(w) / total
        parts.append(f"WHEN {u} < {num(acc)} THEN {v!r}")
    return f"(CASE {' '.join(parts)} ELSE {values[-1]!r} END)"


def flag(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def zero_safe(x: str, replacement: float = 1e-6) -> str:
    return f"(CASE WHEN {x} = 0 THEN {num(replacement)} ELSE {x} END)"


def horner_low(x: str, coefs: Sequence[float]) -> str:
    acc = num(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = f"({acc} * {x} + {num(c)})"
    return acc


def horner_high(x: str, coefs: Sequence[float]) -> str:
    acc = num(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {num(c)})"
    return acc
