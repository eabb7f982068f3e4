"""Distribution functions for p-values (no SciPy in the environment).

Tests reduce to a handful of sufficient statistics computed by Spark; these
functions turn the final scalars into probabilities.  They are exposed both
as plain Python (for scalars) and as Arrow-batched pandas UDFs so a result
DataFrame can carry its p-value column without a driver round trip.

Student t and F use the regularised incomplete beta function evaluated by a
modified Lentz continued fraction; the normal uses ``math.erfc``.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300
_NORMAL = NormalDist()


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of I_x(a, b); it needs of the order of √max(a, b) steps and must converge."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 1000 + int(50 * math.sqrt(max(a, b)))):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 4 * _EPS:
            return h
    raise ArithmeticError(f"incomplete beta did not converge at a={a}, b={b}, x={x}")


def _stirling(x: float) -> float:
    """What Stirling's formula leaves of ln Γ(x), for x ≥ 50."""
    y = 1.0 / (x * x)
    return (1.0 / 12 - y * (1.0 / 360 - y * (1.0 / 1260 - y / 1680))) / x


def log_beta(a: float, b: float) -> float:
    """ln B(a, b) without the difference of two large log-gammas."""
    a, b = max(a, b), min(a, b)
    if a < 50:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    # ln Γ(a + b) − ln Γ(a) by Stirling's series, term by term
    grow = (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + _stirling(a + b) - _stirling(a)
    return math.lgamma(b) - grow


def betainc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b); ``y`` = 1 − x when it is known more exactly."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    front = math.exp(a * log_x + b * log_y - log_beta(a, b))
    # near 1 the fraction in x subtracts nearly equal terms when a is large; in the bulk the one in y does not, in the bulk
    if x < (a + 1.0) / (a + b + 2.0) and not (a > 1e4 and y * a < 10 * (b + 1)):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, y) / b


def _ok(*vals) -> bool:
    return all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in vals)


def _t_as_normal(t: float, df: float) -> float:
    """Normal deviate of |t| for large df (Hill's asymptotic expansion, ACM algorithm 395)."""
    a = df - 0.5
    b = 48.0 * a * a
    z2 = a * math.log1p(t * t / df)
    z = math.sqrt(z2)
    return ((((((-0.4 * z2 - 3.3) * z2 - 24.0) * z2 - 85.5) / (0.8 * z2 * z2 + 100.0 + b) + z2 + 3.0) / b) + 1.0) * z


def t_sf(t: float, df: float) -> float | None:
    """P(T > t) for Student t with ``df`` degrees of freedom."""
    if not _ok(t, df) or df <= 0:
        return None
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    if df > 1e4:
        tail = 0.5 * math.erfc(_t_as_normal(t, df) / math.sqrt(2.0))
        return tail if t > 0 else 1.0 - tail
    tail = 0.5 * betainc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))
    return tail if t > 0 else 1.0 - tail


def t_cdf(t: float, df: float) -> float | None:
    s = t_sf(t, df)
    return None if s is None else 1.0 - s


def t_two_sided(t: float, df: float) -> float | None:
    if not _ok(t, df) or df <= 0:
        return None
    if math.isinf(t):
        return 0.0
    if df > 1e4:
        return math.erfc(_t_as_normal(t, df) / math.sqrt(2.0))
    return min(1.0, betainc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t)))


def t_ppf(p: float, df: float) -> float | None:
    """Quantile of Student t by bisection on the CDF."""
    if not _ok(p, df) or df <= 0 or not 0.0 < p < 1.0:
        return None
    if p == 0.5:
        return 0.0
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > p:
        lo *= 2.0
    while t_cdf(hi, df) < p:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-12 * max(1.0, abs(mid)):
            break
    return 0.5 * (lo + hi)


def f_sf(f: float, d1: float, d2: float) -> float | None:
    """P(F > f) for the F distribution."""
    if not _ok(f, d1, d2) or d1 <= 0 or d2 <= 0:
        return None
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def norm_cdf(z: float) -> float | None:
    if not _ok(z):
        return None
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_sf(z: float) -> float | None:
    if not _ok(z):
        return None
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    return _NORMAL.inv_cdf(p)


# ---- Arrow-batched wrappers (result tables have few rows) ----------------

def _vec(fn, *series: pd.Series) -> pd.Series:
    def clean(v):
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)
    rows = zip(*[s.tolist() for s in series])
    return pd.Series([fn(*[clean(v) for v in r]) for r in rows], dtype="float64")


def _safe(fn):
    def run(*args):
        if any(a is None for a in args):
            return None
        return fn(*args)
    return run


@F.pandas_udf(T.DoubleType())
def t_two_sided_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(_safe(t_two_sided), t, df)


@F.pandas_udf(T.DoubleType())
def t_greater_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    """One-sided p for H1: statistic > 0."""
    return _vec(_safe(t_sf), t, df)


@F.pandas_udf(T.DoubleType())
def t_ppf_udf(p: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(_safe(t_ppf), p, df)


@F.pandas_udf(T.DoubleType())
def f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(_safe(f_sf), f, d1, d2)


@F.pandas_udf(T.DoubleType())
def norm_sf_udf(z: pd.Series) -> pd.Series:
    return _vec(_safe(norm_sf), z)


@F.pandas_udf(T.DoubleType())
def norm_cdf_udf(z: pd.Series) -> pd.Series:
    return _vec(_safe(norm_cdf), z)


@F.pandas_udf(T.DoubleType())
def norm_ppf_udf(p: pd.Series) -> pd.Series:
    return _vec(_safe(lambda x: norm_ppf(x) if 0.0 < x < 1.0 else None), p)
