"""p-values for t and F statistics.

Spark SQL has no t/F distribution function, so the regularised incomplete beta
``I_x(a, b)`` is evaluated by an Arrow-batched pandas UDF (numpy continued
fraction, modified Lentz). It only ever runs on aggregated rows (one per test
or per correlation group), never per review.

  two-sided t:  p = I_{df/(df+t^2)}(df/2, 1/2)
  F (upper):    p = I_{d2/(d2+d1*F)}(d2/2, d1/2)
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Python workers need not have this package installed: the UDF and its helpers
# are shipped by value with the task (numpy/pandas come from the worker's Python).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPS = 1e-15
_TINY = 1e-300
_MAX_ITER = 300

def _lgamma(x) -> np.ndarray:
    """Element-wise log-gamma (a plain function, so it pickles by value)."""
    arr = np.asarray(x, dtype=float)
    return np.array([math.lgamma(v) for v in arr.ravel()], dtype=float).reshape(arr.shape)


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta (modified Lentz), vectorised."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    done = np.zeros_like(x, dtype=bool)
    for m in range(1, _MAX_ITER + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = np.where(done, h, h * d * c)
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        delta = d * c
        h = np.where(done, h, h * delta)
        done |= np.abs(delta - 1.0) < _EPS
        if done.all():
            break
    return h


def betainc_np(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b); NaN where undefined."""
    a = np.asarray(a, dtype=float)
    b = np.asarray(b, dtype=float)
    x = np.asarray(x, dtype=float)
    out = np.full(np.broadcast(a, b, x).shape, np.nan)
    a, b, x = np.broadcast_arrays(a, b, x)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lbt = _lgamma(am + bm) - _lgamma(am) - _lgamma(bm) + am * np.log(xm) + bm * np.log1p(-xm)
        bt = np.exp(lbt)
        direct = xm < (am + 1.0) / (am + bm + 2.0)
        res = np.empty_like(xm)
        if direct.any():
            res[direct] = bt[direct] * _betacf(am[direct], bm[direct], xm[direct]) / am[direct]
        if (~direct).any():
            inv = ~direct
            res[inv] = 1.0 - bt[inv] * _betacf(bm[inv], am[inv], 1.0 - xm[inv]) / bm[inv]
        out[mid] = res
    return out


@F.pandas_udf(DoubleType())
def betainc(a: pd.Series, b: pd.Series, x: pd.Series) -> pd.Series:
    """U1 as an Arrow-batched UDF; NULL in → NULL out."""
    r = betainc_np(a.to_numpy(dtype=float, na_value=np.nan), b.to_numpy(dtype=float, na_value=np.nan), x.to_numpy(dtype=float, na_value=np.nan))
    return pd.Series(r).where(~np.isnan(r), None)


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p of a t statistic; |t| = inf (|r| = 1) gives 0."""
    x = F.try_divide(df, df + t * t)
    return F.when(F.isnull(t) | F.isnull(df) | (df <= 0), F.lit(None).cast("double")).otherwise(
        betainc(df / 2.0, F.lit(0.5), x)
    )


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    """Upper-tail p of an F statistic."""
    x = F.try_divide(d2, d2 + d1 * f)
    return F.when(F.isnull(f) | (d1 <= 0) | (d2 <= 0), F.lit(None).cast("double")).otherwise(
        betainc(d2 / 2.0, d1 / 2.0, x)
    )


def corr_t(r: Column, n: Column) -> Column:
    """t of a correlation: ``r * sqrt((n-2)/(1-r^2))``; |r| = 1 → NULL t, p handled by caller."""
    return r * F.sqrt(F.try_divide(n - 2.0, 1.0 - r * r))


def corr_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p of a Pearson/Spearman r with n pairs (df = n-2); |r| = 1 → 0."""
    return F.when(F.abs(r) >= 1.0, F.lit(0.0)).otherwise(t_pvalue(corr_t(r, n), n - 2.0))
