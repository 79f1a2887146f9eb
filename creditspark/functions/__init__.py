"""Column-level building blocks (all JVM-side expressions)."""

from .core import (Term, clip, flag, linear_score, nan_to_null, ratio, require_columns,
                   round_half_even, sigmoid, trunc_toward_zero, zero_safe)
from .draws import bernoulli, choice, normal, uniform, uniform_between
from .gaussian import Z_999, norm_cdf, norm_ppf, with_norm_cdf, with_norm_ppf

__all__ = [
    "Term", "clip", "flag", "linear_score", "nan_to_null", "ratio", "require_columns",
    "round_half_even", "sigmoid", "trunc_toward_zero", "zero_safe",
    "bernoulli", "choice", "normal", "uniform", "uniform_between",
    "Z_999", "norm_cdf", "norm_ppf", "with_norm_cdf", "with_norm_ppf",
]
