"""Scalar statistics applied to one-row-per-test results.

Test statistics are plain Spark aggregates; the distribution tails below turn a
statistic into a p-value.  They run on result rows only (one row per test or
per column), never per input row.  Closed forms are JVM expressions so they
stay in whole-stage codegen; the general F / t / chi-square tails need the
regularised incomplete beta / gamma functions, evaluated with the standard
continued-fraction and series expansions in a vectorised pandas UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15


def _continued(level, start: int = 64, limit: int = 1 << 16) -> float:
    """Value of a continued fraction, evaluated from its end: ``level(k, rest)`` gives level k
    from the value of all deeper ones.  The depth doubles until the value stands still."""
    value, depth = math.nan, start
    while depth <= limit:
        rest = 0.0
        for k in range(depth, 0, -1):
            rest = level(k, rest)
        if abs(rest - value) <= _EPS * abs(rest):
            break
        value, depth = rest, depth * 2
    return rest


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b), by the fraction 1/(1 + d1/(1 + d2/(1 + ...)))
    with d_2m = m (b - m) x / ((a + 2m - 1)(a + 2m)) and
    d_2m+1 = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1)); the mirror image
    1 - I_1-x(b, a) where that converges faster."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - betainc_reg(b, a, 1.0 - x)

    def level(k: int, rest: float) -> float:
        m = k // 2
        if k % 2 == 0:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return d / (1.0 + rest)

    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / (a * (1.0 + _continued(level)))


def gammaincc_reg(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): up to a + 1 one minus the power series
    sum x^k / (a (a+1) ... (a+k)), beyond it the fraction
    1/(x + (1-a)/(1 + 1/(x + (2-a)/(1 + 2/(x + ...)))))."""
    if x <= 0.0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = 1
        while term > total * _EPS:
            term *= x / (a + k)
            total += term
            k += 1
        return max(0.0, 1.0 - front * total)
    return front / (x + _continued(lambda k, rest: (k - a) / (1.0 + k / (x + rest))))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or d1 is None or d2 is None or any(map(_bad, (f, d1, d2))) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_sf2(t: float, df: float) -> float:
    """Two-sided tail P(|T| >= |t|)."""
    if t is None or df is None or _bad(t) or _bad(df) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or _bad(x) or _bad(df) or df <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    return gammaincc_reg(df / 2.0, x / 2.0)


def norm_sf2(z: float) -> float:
    if z is None or _bad(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def _bad(v) -> bool:
    try:
        return v != v
    except TypeError:
        return True


def _vec(fn, *series: pd.Series) -> pd.Series:
    out = [fn(*[None if pd.isna(v) else float(v) for v in row]) for row in zip(*series)]
    arr = np.array(out, dtype="float64")
    return pd.Series(np.where(np.isnan(arr), np.nan, arr))


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(t_sf2, t, df)


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, df)


@F.pandas_udf(T.DoubleType())
def norm_pvalue(z: pd.Series) -> pd.Series:
    return _vec(norm_sf2, z)


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


# ---- closed forms, JVM side -------------------------------------------------

def chi2_sf_df2(x: Column) -> Column:
    return F.exp(-x / 2.0)


def chi2_sf_df4(x: Column) -> Column:
    return F.exp(-x / 2.0) * (1.0 + x / 2.0)


def f_sf_df1_2(f: Column, d2: Column) -> Column:
    return F.pow(d2 / (d2 + 2.0 * f), d2 / 2.0)


def ks_pvalue(lam: Column, terms: int = 20) -> Column:
    """Tail of the Kolmogorov distribution, by whichever of its two series converges fast:
    the alternating one, 2 * sum (-1)^(k-1) exp(-2 k^2 lam^2), from 1.18 on, and below it
    1 - sqrt(2 pi) / lam * sum exp(-(2k-1)^2 pi^2 / (8 lam^2)); 1 at lam = 0."""
    ks = F.sequence(F.lit(1), F.lit(terms))
    far = 2.0 * F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                            * F.exp(-2.0 * k * k * lam * lam))
    near = 1.0 - F.sqrt(F.lit(2.0 * math.pi)) / lam * F.aggregate(
        ks, F.lit(0.0), lambda acc, k: acc + F.exp(-(2 * k - 1) * (2 * k - 1) * (math.pi ** 2 / 8.0) / (lam * lam)))
    tail = F.when(lam <= 0, 1.0).when(lam < 1.18, near).otherwise(far)
    return F.when(lam.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))


def adjusted_skew(n: Column, g1: Column) -> Column:
    """Sample skewness G1 from the population value g1 (pandas / DuckDB convention)."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(n: Column, k: Column) -> Column:
    """Sample excess kurtosis G2 from the population excess value k."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * k + 6))
