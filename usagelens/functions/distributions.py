"""Distribution functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos' approximation of the gamma function for g = 7.
LANCZOS_G = 7
LANCZOS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
]
#: Steps of a continued fraction; it needs about the root of the larger parameter.
STEPS = 4_000
MOST_FREEDOM = 1e7


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x of 0.5 or more."""
    at = x - 1
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        total = total + c / (at + i)
    t = at + LANCZOS_G + 0.5
    return 0.5 * math.log(2 * math.pi) + (at + 0.5) * F.log(t) - t + F.log(total)


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz' method."""

    def step(state: Column, n: Column, factor: Column) -> Column:
        d = 1 / (1 + factor * state["d"])
        c = 1 + factor / state["c"]
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    def both(state: Column, n: Column) -> Column:
        m = n.cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
        return step(step(state, n, even), n, odd)

    first = 1 / (1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, both, lambda s: s["h"])


def two_sided_t(t: Column, freedom: Column) -> Column:
    """Probability of a value as far from zero as ``t`` under Student's distribution.

    Freedom counts up to ten million, beyond which the distribution no longer changes visibly. Null for
    a null and for no freedom.
    """
    v = F.least(freedom.cast("double"), F.lit(MOST_FREEDOM))
    a, b = v / 2, F.lit(0.5)
    x, rest = v / (v + t * t), t * t / (v + t * t)
    front = F.exp(log_gamma(a + 0.5) - log_gamma(a) - math.lgamma(0.5) + a * F.log(x) + b * F.log(rest))
    near = front * _fraction(x, a, b) / a
    far = 1 - front * _fraction(rest, b, a) / b
    p = F.when(x < (a + 1) / (a + b + 2), near).otherwise(far)
    return F.when(v > 0, F.when(t == 0, F.lit(1.0)).otherwise(p))
