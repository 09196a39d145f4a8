import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.distributions import chi2_log_tail, ln_gamma


def test_ln_gamma(spark):
    z = [0.5, 1.0, 1.5, 2.0, 7.3, 50.0, 1234.5, 1e6]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").select(ln_gamma(F.col("z"))).collect()]
    assert got == [pytest.approx(math.lgamma(x), rel=1e-12, abs=1e-11) for x in z]


def tail(x, dof):
    """Q(dof / 2, x / 2) in closed form: a finite sum, behind erfc for odd dof."""
    h = x / 2
    if dof % 2 == 0:
        return math.fsum(math.exp(k * math.log(h) - h - math.lgamma(k + 1)) for k in range(dof // 2))
    return math.erfc(math.sqrt(h)) + math.fsum(math.exp((k + 0.5) * math.log(h) - h - math.lgamma(k + 1.5)) for k in range((dof - 1) // 2))


def test_chi2_tail(spark):
    rows = [(x, d) for d in (1, 2, 3, 8, 25, 60, 400, 401) for x in (0.01, 0.5, 1.0, 3.84, 20.0, d * 0.9, d * 1.0, d * 1.5, 300.0)]
    got = spark.createDataFrame(rows, "x double, d int").select("x", "d", chi2_log_tail(F.col("x"), F.col("d")).alias("p")).collect()
    for r in got:
        assert math.exp(r.p) == pytest.approx(tail(r.x, r.d), rel=1e-8, abs=1e-300), r
    far = spark.createDataFrame([(5000.0, 3), (6000.0, 3), (0.0, 3), (5.0, 0), (25_000.0, 20_000)], "x double, d int")
    a, b, zero, none, wide = [r[0] for r in far.select(chi2_log_tail(F.col("x"), F.col("d"))).collect()]
    assert b < a < -2400 and zero == none == 0.0
    z = ((25_000 / 20_000) ** (1 / 3) - (1 - 2 / 180_000)) / math.sqrt(2 / 180_000)      # normal approximation by cube roots
    assert wide == pytest.approx(-z * z / 2 - math.log(z * math.sqrt(2 * math.pi)), abs=1)

