"""Distribution functions as column expressions (JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def ln_gamma(z: Column) -> Column:
    """ln of the gamma function for z >= 0.5: Stirling's series at z + 8, less
    the logarithms of the eight factors between (error below 1e-12)."""
    y = z + 8.0
    steps = F.ln(z)
    for i in range(1, 8):
        steps = steps + F.ln(z + float(i))
    # B(2k) / (2k (2k - 1)) of Stirling's series.
    series = F.lit(0.0)
    for power, factor in ((1, 1 / 12), (3, -1 / 360), (5, 1 / 1260), (7, -1 / 1680), (9, 1 / 1188)):
        series = series + F.lit(factor) / F.pow(y, F.lit(float(power)))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def chi2_log_tail(statistic: Column, dof: Column) -> Column:
    """ln of the probability that a chi-squared variable with ``dof`` degrees
    of freedom exceeds ``statistic``; 0 where either is 0.  The logarithm keeps
    tails apart that are too small for a double.

    Left of the mean it is one less the series of the lower incomplete gamma
    function, right of it the continued fraction of the upper one, evaluated from
    its far end; both take about sqrt(dof) terms.
    """
    a, x = dof.cast("double") / 2.0, statistic / 2.0
    n = F.lit(200) + F.floor(F.sqrt(a) * 12.0).cast("int")
    front = a * F.ln(x) - x
    terms = F.aggregate(
        F.sequence(F.lit(1), n), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"), (s["sum"] + s["term"] * x / (a + i)).alias("sum")))
    lower = F.exp(front - ln_gamma(a + 1.0)) * terms["sum"]
    fraction = F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), x + 2.0 * n + 1.0 - a,
                           lambda s, i: x + 2.0 * i - 1.0 - a - F.try_divide(i * (i - a), s))
    return (F.when((a <= 0) | (x <= 0), 0.0).when(x < a + 1.0, F.log1p(-lower))
            .otherwise(front - ln_gamma(a) - F.ln(fraction)))
