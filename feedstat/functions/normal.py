"""Inverse of the normal distribution as a column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of algorithm AS 241 (Wichura 1988, PPND16), highest
# power first. Each pair is (numerator, denominator).
CENTRAL = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853,
     45921.953931549871457, 13731.693765509461125, 1971.5909503065514427,
     133.14166789178437745, 3.3871328727963666080),
    (5226.4952788528545610, 28729.085735721942674, 39307.895800092710610,
     21213.794301586595867, 5394.1960214247511077, 687.18700749205790830,
     42.313330701600911252, 1.0),
)
MIDDLE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
     1.27045825245236838258, 3.64784832476320460504, 5.76949722146069140550,
     4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
     1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940,
     2.05319162663775882187, 1.0),
)
OUTER = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
     2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580,
     5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
     7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
     5.99832206555887937690e-1, 1.0),
)
CENTRAL_HALF_WIDTH = 0.425
CENTRAL_OFFSET = 0.180625
MIDDLE_LIMIT = 5.0
MIDDLE_SHIFT = 1.6


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def _ratio(x: Column, pair: tuple[Sequence[float], Sequence[float]]) -> Column:
    return _polynomial(x, pair[0]) / _polynomial(x, pair[1])


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile of ``p``, evaluated in the JVM; null outside (0, 1)."""
    q = p - 0.5
    central = q * _ratio(CENTRAL_OFFSET - q * q, CENTRAL)
    depth = F.sqrt(-F.ln(F.least(p, 1.0 - p)))
    tail = F.signum(q) * F.when(
        depth <= MIDDLE_LIMIT, _ratio(depth - MIDDLE_SHIFT, MIDDLE)
    ).otherwise(_ratio(depth - MIDDLE_LIMIT, OUTER))
    return F.when(
        (p > 0) & (p < 1), F.when(F.abs(q) <= CENTRAL_HALF_WIDTH, central).otherwise(tail)
    )
