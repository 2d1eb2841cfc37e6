"""Frozen normalisation as column expressions over the statistic's columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The supported methods.
METHODS = (
    "identity",
    "zscore",
    "robust_zscore",
    "minmax",
    "log1p_zscore",
    "signed_log1p_zscore",
)


def _stat(name: str, stat: Column | None) -> Column:
    return F.col(name) if stat is None else stat[name]


def normalize(x: Column, stat: Column | None = None) -> Column:
    """Normalised value by the row's method; NULL when the method has no value there."""
    def s(name: str) -> Column:
        return _stat(name, stat)

    lo = F.coalesce(s("out_lo"), F.lit(0.0))
    hi = F.coalesce(s("out_hi"), F.lit(1.0))
    shifted = x + F.coalesce(s("epsilon"), F.lit(0.0))
    method = F.lower(F.coalesce(s("method"), F.lit("identity")))
    return (
        F.when(method == "identity", x)
        .when(method == "zscore", (x - s("mean")) / s("std"))
        .when(method == "robust_zscore", (x - s("median")) / s("scale"))
        .when(method == "minmax", lo + (x - s("min")) * (hi - lo) / (s("max") - s("min")))
        .when(
            (method == "log1p_zscore") & (shifted > -1.0),
            (F.log1p(shifted) - s("mean")) / s("std"),
        )
        .when(
            method == "signed_log1p_zscore",
            (F.signum(x) * F.log1p(F.abs(x)) - s("mean")) / s("std"),
        )
    )


def denormalize(y: Column, stat: Column | None = None) -> Column:
    """Inverse of :func:`normalize`; NULL where the inverse is not finite."""
    def s(name: str) -> Column:
        return _stat(name, stat)

    lo = F.coalesce(s("out_lo"), F.lit(0.0))
    hi = F.coalesce(s("out_hi"), F.lit(1.0))
    z = y * s("std") + s("mean")
    method = F.lower(F.coalesce(s("method"), F.lit("identity")))
    value = (
        F.when(method == "identity", y)
        .when(method == "zscore", z)
        .when(method == "robust_zscore", y * s("scale") + s("median"))
        .when(method == "minmax", s("min") + (y - lo) * (s("max") - s("min")) / (hi - lo))
        .when(method == "log1p_zscore", F.expm1(z) - F.coalesce(s("epsilon"), F.lit(0.0)))
        .when(method == "signed_log1p_zscore", F.signum(z) * F.expm1(F.abs(z)))
    )
    return F.when(is_finite(value), value)


def is_finite(x: Column) -> Column:
    """False for NULL, NaN and the infinities."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
