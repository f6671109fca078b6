"""Column expressions on lap fractions, which wrap at 1."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def frac(x: Column) -> Column:
    return F.pmod(x, F.lit(1.0))


def gap(a: Column, b: Column) -> Column:
    """Forward distance from ``a`` to ``b``."""
    return frac(b - a)


def distance(a: Column, b: Column, lap: float = 1.0) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(lap))
    return F.least(d, F.lit(lap) - d)


def signed(d: Column) -> Column:
    """The difference brought to -0.5 .. 0.5."""
    return frac(d + 0.5) - 0.5


def midpoint(a: Column, b: Column) -> Column:
    return frac(a + gap(a, b) / 2.0)


def mean(x: Column) -> Column:
    """Aggregate: circular mean."""
    return frac(F.atan2(F.sum(F.sin(x * (2 * pi))), F.sum(F.cos(x * (2 * pi)))) / (2 * pi))
