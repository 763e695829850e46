"""Tails of the normal, chi-squared and Student distributions, for p-values of small result tables."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_tail(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, k: float) -> float:
    """Upper tail: the regularised incomplete gamma function by its series or continued fraction."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-15 * abs(total):
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    # Lentz's method
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_quantile(share: float, k: float) -> float:
    """The value that this share of the distribution lies below, by bisection."""
    low, high = 0.0, 1.0
    while chi2_tail(high, k) > 1 - share:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, k) > 1 - share else (low, middle)
    return (low + high) / 2


def beta_regularised(x: float, a: float, b: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_regularised(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or 1e-300)
            c = 1 + num / c or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def student_tail(t: float, df: float) -> float:
    """Two-sided."""
    return beta_regularised(df / (df + t * t), df / 2, 0.5)


def _each(f, *columns: pd.Series) -> pd.Series:
    return pd.Series([None if any(pd.isna(v) for v in row) else f(*row) for row in zip(*columns)], dtype="float64")


@F.pandas_udf(DoubleType())
def p_normal(z: pd.Series) -> pd.Series:
    return _each(normal_tail, z)


@F.pandas_udf(DoubleType())
def p_chi2(x: pd.Series, k: pd.Series) -> pd.Series:
    return _each(chi2_tail, x, k)


@F.pandas_udf(DoubleType())
def p_student(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(student_tail, t, df)
