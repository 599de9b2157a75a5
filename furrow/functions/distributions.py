"""Tail probabilities for test statistics, on rows that are already aggregated."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_quantile(confidence: float) -> float:
    """Two-sided critical value of the standard normal."""
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 200_000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return total
    raise ArithmeticError(f"the fraction did not converge for a={a}, b={b}, x={x}")


def _lgamma_step(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a) without the cancellation that large ``a`` would bring:
    from 1e4 on by the Stirling series, whose next term is below 1e-18 there."""
    if a < 1e4:
        return math.lgamma(a + b) - math.lgamma(a)

    def rest(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z**3)

    return (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + rest(a + b) - rest(a)


def student_t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t, through the regularised incomplete beta function."""
    if not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return float("nan")
    if df >= 1e8:
        # So near the normal limit that one correction term leaves less than 1e-9 of the
        # tail even at t = 10, where the fraction below would lose digits.
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        return math.erfc(abs(t) / math.sqrt(2)) + density * (abs(t) ** 3 + abs(t)) / (2 * df)
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    # x is df / (df + t * t): its logarithm and that of 1 - x from the small ratio.
    ratio = t * t / df
    log_front = _lgamma_step(a, b) - math.lgamma(b) - a * math.log1p(ratio) + b * (math.log(ratio) - math.log1p(ratio))
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return min(1.0, front * _beta_fraction(a, b, x) / a)
    return max(0.0, 1.0 - front * _beta_fraction(b, a, t * t / (df + t * t)) / b)


def t_p_value(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        return pd.Series([student_t_two_sided(x, n) for x, n in zip(ts, dfs)], dtype="float64")

    return F.when(t.isNotNull() & df.isNotNull(), tail(t.cast("double"), df.cast("double")))


def kolmogorov_tail(x: float) -> float:
    """P(K > x) of the Kolmogorov limit distribution."""
    if x <= 0:
        return 1.0
    if x < 1.18:
        k = np.arange(1, 20)
        below = math.sqrt(2 * math.pi) / x * np.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * x * x)).sum()
        return float(min(1.0, max(0.0, 1.0 - below)))
    k = np.arange(1, 20)
    return float(max(0.0, 2.0 * ((-1.0) ** (k - 1) * np.exp(-2.0 * (k * x) ** 2)).sum()))


def ks_exact_tail(distance: float, n: int, m: int) -> float:
    """P(D >= ``distance``) for samples of ``n`` and ``m`` without ties.

    Merging the samples is a walk from (0, 0) to (n, m) on a lattice, every walk alike likely.
    The walks that stay nearer than the distance are counted diagonal by diagonal, as a
    share of all walks to a point, so that no number grows."""
    reach = round(distance * n * m)
    if reach <= 0:
        return 1.0
    share = np.zeros(n + 2)  # share[i + 1]: walks to (i, s - i)
    share[1] = 1.0
    for s in range(1, n + m + 1):
        i = np.arange(max(0, s - m), min(n, s) + 1)
        j = s - i
        inside = np.abs(i * m - j * n) < reach
        new = np.zeros_like(share)
        new[i + 1] = np.where(inside, (share[i] * i + share[i + 1] * j) / s, 0.0)
        share = new
    return float(min(1.0, max(0.0, 1.0 - share[n + 1])))


#: Samples of at most so many rows get the exact p-value, larger ones the limit's.
EXACT_UP_TO = 10_000


def ks_p_value(statistic: Column, n_left: Column, n_right: Column, exact_up_to: int = EXACT_UP_TO) -> Column:
    """P-value of the two-sample Kolmogorov-Smirnov statistic: exact if neither sample is
    larger than ``exact_up_to``, else from the limit distribution."""

    @F.pandas_udf("double")
    def tail(ds: pd.Series, ns: pd.Series, ms: pd.Series) -> pd.Series:
        def one(d: float, n: float, m: float) -> float:
            # Also reached by rows that the condition below leaves out.
            if not (d >= 0 and n > 0 and m > 0):
                return math.nan
            if max(n, m) <= exact_up_to:
                return ks_exact_tail(d, int(n), int(m))
            return kolmogorov_tail(d * math.sqrt(n * m / (n + m)))

        return pd.Series([one(d, n, m) for d, n, m in zip(ds, ns, ms)], dtype="float64")

    left, right = n_left.cast("double"), n_right.cast("double")
    return F.when(statistic.isNotNull() & (left > 0) & (right > 0), tail(statistic, left, right))
