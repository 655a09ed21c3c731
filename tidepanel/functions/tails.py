"""Driver-side distribution functions for test statistics (scalars only).

scipy is not available, so the t, F and chi-square tails come from the
regularised incomplete beta and gamma functions (series and continued
fractions of the Digital Library of Mathematical Functions), and the normal from ``statistics.NormalDist``.
"""

from __future__ import annotations

import math
from statistics import NormalDist

_EPS = 1e-15


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of DLMF 8.17.22, summed from its tail.

    Its terms settle after a number that grows with the root of the larger
    parameter.
    """
    value = 0.0
    for m in range(60 + int(6 * math.sqrt(max(a, b))), -1, -1):
        even = (m + 1) * (b - m - 1) * x / ((a + 2 * m + 1) * (a + 2 * m + 2))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = odd / (1.0 + even / (1.0 + value))
    return 1.0 / (1.0 + value)


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(lbt) * _beta_fraction(b, a, 1.0 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): the power series of its
    complement (DLMF 8.7.1) for small x, else the fraction of DLMF 8.9.2 from
    its tail."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = 1
        while term > total * _EPS:
            term *= x / (a + k)
            total += term
            k += 1
        return 1.0 - front * total
    value = x
    for k in range(80 + int(8 * math.sqrt(x)), 0, -1):
        value = x + (k - a) / (1.0 + k / value)
    return front / value


def chi2_sf(x: float, k: float) -> float:
    return gammainc_upper(k / 2.0, x / 2.0)


def norm_cdf(z: float) -> float:
    return NormalDist().cdf(z)


def norm_ppf(p: float) -> float:
    return NormalDist().inv_cdf(p)


# MacKinnon (1994) response-surface constants for the
# Dickey-Fuller tau statistic, regression with a constant, one variable.
ADF_C_TAU_MAX = 2.74
ADF_C_TAU_MIN = -18.83
ADF_C_TAU_STAR = -1.61
ADF_C_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_C_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_pvalue(stat: float) -> float:
    """Approximate p-value of an ADF statistic (constant, no trend)."""
    if stat is None or math.isnan(stat):
        return float("nan")
    if stat > ADF_C_TAU_MAX:
        return 1.0
    if stat < ADF_C_TAU_MIN:
        return 0.0
    coef = ADF_C_SMALL_P if stat <= ADF_C_TAU_STAR else ADF_C_LARGE_P
    z = sum(c * stat ** i for i, c in enumerate(coef))
    return norm_cdf(z)
