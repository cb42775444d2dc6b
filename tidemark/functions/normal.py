"""The normal distribution as column expressions, which stay inside generated code."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's 1968 double-precision rational approximation of the upper tail,
# highest power first (numerator, denominator).
TAIL_TOP = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
TAIL_BOTTOM = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi))


def upper_tail(size: Column) -> Column:
    """P(Z > size) for size >= 0, to about 1e-15.

    `size` appears many times, so pass a plain column: the code generated for it must stay
    short enough for the JVM to compile. Past seven deviations the value is below 1e-12
    and the fraction's own limit, the normal density over `size`, is close enough.
    """
    weight = F.exp(-size * size / F.lit(2.0))
    return weight * _polynomial(size, TAIL_TOP) / _polynomial(size, TAIL_BOTTOM)


def normal_cdf(x: Column) -> Column:
    """P(Z <= x)."""
    tail = upper_tail(F.abs(x))
    return F.when(x > 0, F.lit(1.0) - tail).otherwise(tail)
