"""Tail probabilities of test statistics as column expressions.

Spark SQL has no Student-t, normal or chi-squared distribution. Tails of smooth
densities are integrated by a double-exponential rule, which keeps about
thirteen digits however far out the tail begins. NULL in, NULL out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: Nodes on each side of zero, and their distance: exp(pi/2 sinh(4)) is beyond 1e18.
NODES = 64
STEP = 1 / 16
#: Steps up to where the asymptotic series of the gamma ratio has fourteen digits.
SHIFT = 16


def _tail_integral(density, start: Column, scale: Column) -> Column:
    """Integral of ``density`` from ``start`` to infinity; ``scale`` is about how far it reaches."""
    def part(k: Column) -> Column:
        q = k * F.lit(STEP)
        reach = F.exp(F.lit(math.pi / 2) * F.sinh(q)) * scale
        return density(start + reach) * reach * F.cosh(q) * F.lit(STEP * math.pi / 2)

    parts = F.transform(F.sequence(F.lit(-NODES), F.lit(NODES)), part)
    return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)


def _log_gamma_ratio(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a)) without cancellation for large ``a``."""
    z = a + F.lit(float(SHIFT))
    y = F.lit(1.0) / z
    series = y * (F.lit(-1 / 8) + y * y * (F.lit(1 / 192) + y * y * (F.lit(-1 / 640) + y * y * F.lit(17 / 14336))))
    down = F.aggregate(
        F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0),
        lambda total, i: total - F.log1p(F.lit(0.5) / (a + i)))
    return F.log(z) / F.lit(2.0) + series + down


def student_t_two_sided(t: Column, dof: Column) -> Column:
    """P(|T| >= |t|) for any positive number of degrees of freedom."""
    t, dof = F.abs(t.cast("double")), dof.cast("double")
    log_scale = _log_gamma_ratio(dof / 2) - F.log(dof * F.lit(math.pi)) / 2
    power = (dof + 1) / 2
    rate = (dof + 1) * t / (dof + t * t)
    tail = _tail_integral(
        lambda u: F.exp(log_scale - power * F.log1p(u * u / dof)), t, F.lit(1.0) / F.sqrt(rate * rate + 1))
    # LEAST would pass over a NULL.
    return F.when(tail.isNotNull(), F.least(F.lit(2.0) * tail, F.lit(1.0)))


def _erfc(z: Column) -> Column:
    scale = F.lit(1.0) / (z + 1)
    return F.lit(2 / math.sqrt(math.pi)) * _tail_integral(lambda u: F.exp(-u * u), z, scale)


def chi_squared_tail(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for an integer number of degrees of freedom; 1 below one degree.

    Starts from Q(1/2, x) = erfc(sqrt x) or Q(1, x) = exp(-x) and adds
    x**a exp(-x) / gamma(a + 1) for each a up to dof/2.
    """
    x, dof = statistic.cast("double") / 2, dof.cast("int")
    odd = dof % 2 == 1
    shape = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    log_gamma = F.when(odd, F.lit(math.lgamma(1.5))).otherwise(F.lit(0.0))
    first = F.when(odd, _erfc(F.sqrt(x))).otherwise(F.exp(-x))
    steps = F.floor((dof - 1) / 2).cast("int")
    start = F.struct(first.alias("tail"), (shape * F.log(x) - x - log_gamma).alias("term"))

    def add(state: Column, i: Column) -> Column:
        return F.struct(
            (state["tail"] + F.exp(state["term"])).alias("tail"),
            (state["term"] + F.log(x) - F.log(shape + i)).alias("term"))

    indices = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    tail = F.aggregate(indices, start, add, lambda state: state["tail"])
    known = statistic.isNotNull() & dof.isNotNull()
    return F.when(known & ((x <= 0) | (dof < 1)), F.lit(1.0)).when(known, F.least(tail, F.lit(1.0)))
