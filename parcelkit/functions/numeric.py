"""Numeric and date Column builders."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; null stays null (least/greatest would skip nulls)."""
    c = _col(c)
    out = c
    if lo is not None and hi is not None:
        out = F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)
    elif lo is not None:
        out = F.when(c < lo, F.lit(lo)).otherwise(c)
    elif hi is not None:
        out = F.when(c > hi, F.lit(hi)).otherwise(c)
    return out


def round_half_even(c) -> Column:
    return F.bround(_col(c).cast("double"), 0).cast("bigint")


def safe_ratio(num, den, default=None) -> Column:
    """num/den when den > 0 (and both present), else ``default``."""
    num, den = _col(num), _col(den)
    r = F.when(den > 0, num / den)
    return r if default is None else F.coalesce(r, F.lit(default))


def nonneg_diff(a, b) -> Column:
    return F.greatest(F.lit(0.0), _col(a) - _col(b))


def deviation(actual, predicted) -> Column:
    """Relative deviation |a-p|/p; null when p is 0."""
    a, p = _col(actual), _col(predicted)
    return F.try_divide(F.abs(a - p), p)


def finite_or_zero(c) -> Column:
    """null / NaN / +-inf -> 0.0 (NaN is above every number)."""
    c = _col(c).cast("double")
    return F.when(F.abs(c) < float("inf"), c).otherwise(F.lit(0.0))


def log_grid(lo_exp: float, hi_exp: float, n: int) -> list[float]:
    """n points evenly spaced in log10 between 10**lo_exp and 10**hi_exp."""
    if n == 1:
        return [10.0 ** lo_exp]
    step = (hi_exp - lo_exp) / (n - 1)
    return [math.pow(10.0, lo_exp + i * step) for i in range(n)]


# --------------------------------------------------------------- dates ----
# Right-closed age bins (upper edge inclusive) and labels.
AGE_BINS = [
    (5, "New"),
    (10, "5-10 years"),
    (20, "10-20 years"),
    (30, "20-30 years"),
    (50, "30-50 years"),
]
AGE_TOP_LABEL = "50+ years"


def age_category(age) -> Column:
    age = _col(age)
    expr = None
    for edge, label in AGE_BINS:
        cond = age <= edge
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(age.isNull(), F.lit(None)).otherwise(expr.otherwise(F.lit(AGE_TOP_LABEL)))


def valid_year(y, as_of_year: int, floor_year: int = 1700) -> Column:
    y = _col(y)
    return y.isNotNull() & (y > floor_year) & (y <= as_of_year)
