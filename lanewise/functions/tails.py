"""Upper-tail probabilities for result-sized rows, accurate far into the tail.

Only test results (one row per test or coefficient) pass through Python; pairs of groups, which
may be many, through a column expression. Incomplete gamma and beta functions take their leading
factor from deviances and Stirling errors, so they keep their digits at any size of parameters.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these functions with the tasks, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 1/12, 1/360, ...: the terms of Stirling's series.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def _stirling_error(z: float) -> float:
    """log Gamma(z + 1) less Stirling's formula, without the loss of digits of a difference."""
    if z < 15:
        return math.lgamma(z + 1) - (z + 0.5) * math.log(z) + z - 0.5 * math.log(2 * math.pi)
    return sum(c / z ** (2 * k + 1) for k, c in enumerate(_STIRLING))


def _deviance(x: float, m: float) -> float:
    """``x log(x / m) + m - x``, exact also where x and m are large and close."""
    v = (x - m) / (x + m)
    if abs(v) > 0.1:
        return x * math.log(x / m) + m - x
    total, power, k = (x - m) * v, 2 * x * v, 1
    while True:
        power *= v * v
        k += 2
        if total + power / k == total:
            return total
        total += power / k


def _steps(size: float) -> int:
    """Enough terms for a series or fraction, which needs some multiple of the root."""
    return 1000 + int(50 * math.sqrt(size))


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: power series, then Lentz's continued fraction."""
    if x <= 0:
        return 1.0
    front = math.exp(-_stirling_error(a) - _deviance(a, x)) / math.sqrt(2 * math.pi * a)
    if x < a + 1:
        term = total = 1.0
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, _steps(a)):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            return front * a * h
    raise ArithmeticError(f"the gamma tail at {a}, {x} did not converge")


def beta_regularised(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta at x = 1 - y by a continued fraction, for any a, b > 0.

    The caller gives both x and y, as either may be too small to be told from a difference.
    """
    if x <= 0:
        return 0.0
    if y <= 0:
        return 1.0
    n = a + b
    if x > (a + 1) / (n + 2):
        return 1.0 - beta_regularised(b, a, y, x)
    front = math.exp(
        _stirling_error(n) - _stirling_error(a) - _stirling_error(b)
        - _deviance(a, n * x) - _deviance(b, n * y)
    ) * math.sqrt(a * b / (2 * math.pi * n))
    # Pairs of terms of the usual fraction at once: in this form nothing large is subtracted.
    tiny, start = 1e-300, a * y - b * x + 1
    h = a * start / (a + 1) or tiny
    c, d = h, 0.0
    for m in range(1, _steps(max(a, b))):
        low = a + 2 * m - 1
        over = (a + m - 1) / low * ((n + m - 1) / low) * m * (b - m) * x * x
        under = m + m * (b - m) * x / low + (a + m) * (start + m * (1 + y)) / (low + 2)
        d = 1 / (under + over * d or tiny)
        c = under + over / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            return front / h
    raise ArithmeticError(f"the beta function at {a}, {b}, {x} did not converge")


def binomial_lower(hits: int, n: int, rate: float) -> float:
    """The chance of at most ``hits`` in ``n`` draws of chance ``rate``, for any n."""
    if hits < 0:
        return 0.0
    if hits >= n:
        return 1.0
    return beta_regularised(n - hits, hits + 1, 1 - rate, rate)


def chi2_upper(statistic: float, df: float) -> float:
    return _gamma_upper(df / 2, statistic / 2)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def t_two_sided(t: float, df: float) -> float:
    if math.isinf(t):
        return 0.0
    whole = df + t * t
    return beta_regularised(df / 2, 0.5, df / whole, t * t / whole)


def f_upper(statistic: float, df_model: float, df_resid: float) -> float:
    if statistic <= 0:
        return 1.0
    whole = df_resid + df_model * statistic
    return beta_regularised(
        df_resid / 2, df_model / 2, df_resid / whole, df_model * statistic / whole)


def t_quantile_two_sided(level: float, df: float) -> float:
    """The t with ``P(|T| <= t) = level``, by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > 1 - level:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if t_two_sided(middle, df) > 1 - level:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _known(*values) -> bool:
    return all(v is not None and not math.isnan(v) for v in values)


@F.pandas_udf(T.DoubleType())
def chi2_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [chi2_upper(s, k) if _known(s, k) and k > 0 else None for s, k in zip(statistic, df)],
        dtype="float64",
    )


#: Where half of the scaled argument (x - BEND) / (x + BEND) lies, and the degree in it.
_BEND, _DEGREE = 3.0, 22


def _scaled_erfc(x: float) -> float:
    """``exp(x * x) * erfc(x)``."""
    if x < 3:
        return math.exp(x * x) * math.erfc(x)
    f = 0.0
    for k in range(200, 0, -1):
        f = k / 2 / (x + f)
    return 1 / ((x + f) * math.sqrt(math.pi))


def _erfc_coefficients() -> list[float]:
    """A polynomial in (x - BEND) / (x + BEND) for ``_scaled_erfc(x) * (x + BEND) / BEND``, which
    is smooth up to infinity, through its values at Chebyshev's points."""
    at = np.cos(np.pi * (np.arange(_DEGREE + 1) + 0.5) / (_DEGREE + 1))
    x = _BEND * (1 + at) / (1 - at)
    values = [_scaled_erfc(v) * (v + _BEND) / _BEND for v in x]
    chebyshev = np.polynomial.chebyshev
    return chebyshev.cheb2poly(chebyshev.chebfit(at, values, _DEGREE)).tolist()


_ERFC = _erfc_coefficients()


def normal_p(z: str | Column) -> Column:
    """The two-sided normal tail as a column expression, to 1e-12 of itself down to 1e-300.

    Null and NaN give null. It is as many multiplications as the polynomial's degree, and so
    stays within generated code: no row goes to a Python worker.
    """
    z = (F.col(z) if isinstance(z, str) else z).cast("double")
    x = F.least(F.abs(z) / math.sqrt(2), F.lit(40.0))
    at = (x - _BEND) / (x + _BEND)
    smooth = F.lit(_ERFC[-1])
    for c in reversed(_ERFC[:-1]):
        smooth = smooth * at + c
    return F.when(z.isNotNull() & ~F.isnan(z), smooth * _BEND / (x + _BEND) * F.exp(-x * x))


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [t_two_sided(v, k) if _known(v, k) and k > 0 else None for v, k in zip(t, df)],
        dtype="float64",
    )
