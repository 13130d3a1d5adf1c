"""Tail probabilities for test results.

These are pandas UDFs, called on finished statistics: one value per test, never
per row of a table.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300
_CLOSE = 1e-15
_MAX_STEPS = 5_000_000
_GAMMA_LIMIT = 1e6


def _stirling_rest(x: float) -> float:
    return 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _log_gamma_step(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a), without the cancellation a large ``a`` brings."""
    if a < 1e4:
        return math.lgamma(a + b) - math.lgamma(a)
    return (
        (a - 0.5) * math.log1p(b / a)
        + b * math.log(a + b)
        - b
        + _stirling_rest(a + b)
        - _stirling_rest(a)
    )


def _fraction(terms) -> float:
    """Value of b0 + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    _, b0 = next(terms)
    value = b0 or _TINY
    upper, lower = value, 0.0
    for a, b in terms:
        lower = b + a * lower or _TINY
        upper = b + a / upper or _TINY
        lower = 1 / lower
        change = upper * lower
        value *= change
        if abs(change - 1) < _CLOSE:
            return value
    raise ArithmeticError(f"a tail probability did not settle within {_MAX_STEPS} steps")


def _beta_terms(a: float, b: float, x: float):
    yield 0.0, 1.0
    yield -(a + b) * x / (a + 1), 1.0
    for m in range(1, _MAX_STEPS):
        yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0


def beta_tail(a: float, b: float, x: float, rest: float) -> float:
    """Regularised incomplete beta I_x(a, b); ``rest`` is 1 - x, given exactly."""
    if x <= 0:
        return 0.0
    if rest <= 0:
        return 1.0
    log_x = math.log1p(-rest) if rest < 0.5 else math.log(x)
    if a > _GAMMA_LIMIT * max(1.0, b):
        # The fraction cancels here, and Wise's gamma limit is off by about 1/a**2 only.
        return gamma_upper(b, -(a + (b - 1) / 2) * log_x)
    small, large = min(a, b), max(a, b)
    log_beta = math.lgamma(small) - _log_gamma_step(large, small)
    log_rest = math.log1p(-x) if x < 0.5 else math.log(rest)
    weight = math.exp(a * log_x + b * log_rest - log_beta)
    if x * (a + b + 2) < a + 1:
        return weight / a / _fraction(_beta_terms(a, b, x))
    return 1 - weight / b / _fraction(_beta_terms(b, a, rest))


def _gamma_terms(a: float, x: float):
    yield 0.0, x + 1 - a
    for i in range(1, _MAX_STEPS):
        yield -i * (i - a), x + 2 * i + 1 - a


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    weight = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x >= a + 1:
        return weight / _fraction(_gamma_terms(a, x))
    term = total = 1 / a
    n = a
    while term > total * _CLOSE:
        n += 1
        term *= x / n
        total += term
    return 1 - weight * total


def f_upper(x: float, d1: float, d2: float) -> float:
    if math.isinf(x):
        return 0.0
    return beta_tail(d2 / 2, d1 / 2, d2 / (d2 + d1 * x), d1 * x / (d2 + d1 * x))


def _over(function, *series: pd.Series) -> pd.Series:
    rows = zip(*series)
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else function(*map(float, row)) for row in rows],
        dtype="float64",
    )


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    """P(|T| >= |t|)."""
    return _over(lambda value, d: f_upper(value * value, 1.0, d), t, dof)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """P(F >= f)."""
    return _over(f_upper, f, d1, d2)


@F.pandas_udf(DoubleType())
def chi_square_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    """P(X >= x)."""
    return _over(lambda value, d: gamma_upper(d / 2, value / 2), x, dof)


@F.pandas_udf(DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """P(Z >= z)."""
    return _over(lambda value: math.erfc(value / math.sqrt(2)) / 2, z)
