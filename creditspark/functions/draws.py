"""Keyed pseudo-random draws.

A draw is a pure function of (key, salt): the same loan gets the same number
however the data is partitioned, re-planned or retried after a lost executor.
Spark's ``rand()`` is seeded per partition and so changes with the partition
count; these do not.

For an integer salt n: ``u(key, n) = int(hex digits 8·(n % 4)+1 .. +8 of
md5(key ':' n // 4)) / 2^32`` in [0, 1); a string salt uses the first 8 digits
of md5(key ':' salt). DuckDB reproduces it bit for bit with
``CAST(('0x' || substr(md5(key || ':' || g), 1 + 8·c, 8)) AS BIGINT) / 4294967296.0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import ColumnOrName, col_
from .gaussian import norm_ppf

TWO_32 = 4294967296.0


def _digest(key: ColumnOrName, group: int | str) -> Column:
    return F.md5(F.concat(col_(key).cast("string"), F.lit(f":{group}")))


def _chunk(key: ColumnOrName, salt: str | int) -> Column:
    """8 hex digits of the digest that ``salt`` owns: salt n uses chunk n % 4 of md5(key ':' n // 4).

    Four salts share one digest; within one projection Catalyst's subexpression
    elimination computes that digest once per row.
    """
    if isinstance(salt, int):
        group, part = salt // 4, salt % 4
    else:
        group, part = salt, 0
    return F.substring(_digest(key, group), 1 + 8 * part, 8)


def uniform(key: ColumnOrName, salt: str | int) -> Column:
    """D1: uniform in [0, 1) determined by ``key`` and ``salt``."""
    # via bigint: the same value as a direct string→double cast, with far less generated code
    return F.conv(_chunk(key, salt), 16, 10).cast("long").cast("double") / F.lit(TWO_32)


def uniform_between(key: ColumnOrName, salt: str | int, lo: float, width: float) -> Column:
    """``lo + width·u``: uniform on [lo, lo + width) (width given, not hi − lo, to keep the literal exact)."""
    return F.lit(float(lo)) + F.lit(float(width)) * uniform(key, salt)


def bernoulli(key: ColumnOrName, salt: str | int, p: ColumnOrName) -> Column:
    """D2: 1 with probability ``p`` (NULL p gives 0)."""
    return F.when(uniform(key, salt) < col_(p), F.lit(1)).otherwise(F.lit(0))


def choice(key: ColumnOrName, salt: str | int, values: Sequence, weights: Sequence[float]) -> Column:
    """D3: weighted choice by cumulative thresholds on one uniform draw."""
    if len(values) != len(weights) or not values:
        raise ValueError("values and weights must be non-empty and the same length")
    total = float(sum(weights))
    u = uniform(key, salt)
    out = None
    acc = 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += float(w) / total
        cond = u < F.lit(acc)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    last = F.lit(values[-1])
    return last if out is None else out.otherwise(last)


def normal(key: ColumnOrName, salt: str | int, mean: float = 0.0, sd: float = 1.0) -> Column:
    """D4: normal draw via the inverse CDF of a mid-bucket uniform in (0, 1)."""
    mid = (F.conv(_chunk(key, salt), 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(TWO_32)
    return F.lit(float(mean)) + F.lit(float(sd)) * norm_ppf(mid)
