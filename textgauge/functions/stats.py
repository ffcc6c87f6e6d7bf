"""Numeric expressions: calibration bins and the chi-square tail."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_edges(bins: int) -> list[float]:
    """Equally spaced edges of [0, 1], with the floating-point values of step multiples."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def bin_index(p: Column, bins: int, zero_in_first: bool) -> Column:
    """1-based bin of a probability; bins are open below and closed above.

    Zero lies in no bin unless ``zero_in_first``.  A chain of comparisons with literals, no join.
    """
    edges = bin_edges(bins)
    low = F.lit(True) if zero_in_first else p > 0.0
    out = F.lit(None).cast("int")
    for i in range(bins, 0, -1):
        out = F.when(p <= F.lit(edges[i]), F.lit(i)).otherwise(out)
    return F.when(low, out)


def chi2_tail(stat: Column, dof: Column) -> Column:
    """P(X >= stat) for a chi-square variable.

    With s = dof/2 and y = stat/2 and t_0 = y^s e^-y / gamma(s+1): up to y = s + 1 one less the series of the lower
    incomplete gamma function, whose terms are t_n = t_(n-1) * y / (s+n); beyond it the continued fraction of
    the upper one, s t_0 / (y+1-s - 1(1-s)/(y+3-s - 2(2-s)/(y+5-s - ...))), which keeps its digits however small the
    tail is.  Meant for result rows, not data rows.
    """
    s = dof.cast("double") / 2
    y = stat.cast("double") / 2
    whole = (dof % 2) == 0
    start = F.when(whole, F.lit(0.0)).otherwise(F.lit(math.log(math.pi) / 2))
    steps = F.sequence(F.lit(0), F.floor(s).cast("int"))
    log_gamma = F.aggregate(
        steps,
        start,
        lambda acc, i: acc + F.when(whole, F.when(i > 0, F.log(i.cast("double"))).otherwise(0.0)).otherwise(
            F.log(i + F.lit(0.5))
        ),
    )
    first = F.exp(s * F.log(y) - y - log_gamma)
    state = F.struct(first.alias("term"), first.alias("total"))
    terms = F.sequence(F.lit(1), F.greatest(F.lit(200), (F.least(y, s + 1) * 4).cast("int")))

    def add(acc: Column, n: Column) -> Column:
        term = acc["term"] * y / (s + n)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    lower = F.aggregate(terms, state, add)["total"]
    depth = 400
    fraction = F.aggregate(
        F.sequence(F.lit(depth), F.lit(1)),
        (y + F.lit(2.0 * depth + 1) - s),
        lambda below, i: (y + 2 * i - 1 - s) - i * (i - s) / below,
    )
    return (
        F.when(stat.isNull() | F.isnan(stat), None)
        .when(stat <= 0, F.lit(1.0))
        .when(y > s + 1, first * s / fraction)
        .otherwise(F.greatest(F.lit(0.0), 1.0 - lower))
    )
