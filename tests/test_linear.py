import numpy as np
import pytest

from tessera.operators import linear


def test_ols_fixture(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    r = linear.ols(df, "x", "y").first()
    assert (r.n, r.slope, r.intercept) == (3, pytest.approx(2.0), pytest.approx(1.0))


def test_first_gd_step_fixture(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    it, cost, m, b = linear.gd_history(linear.gram_stats(df, ["x"], "y"), 1e-4, 1)[0][:4]
    assert (it, cost) == (1, pytest.approx(83.0))
    assert m == pytest.approx(0.002266667, abs=1e-9) and b == pytest.approx(0.001, abs=1e-12)


def _direct(X, y, rate, steps, bold):
    """Per-step gradient descent written out directly on the rows."""
    n, p = X.shape
    m, b, prev, out = np.zeros(p), 0.0, float("inf"), []
    for it in range(1, steps + 1):
        e = y - (X @ m + b)
        cost = float(np.sum(e ** 2))
        m = m - rate * (-2.0 / n * (X.T @ e))
        b = b - rate * (-2.0 / n * np.sum(e))
        if bold:
            rate = rate * 1.05 if cost < prev else rate * 0.5
            prev = cost
        out.append((it, cost, *m, b, rate))
    return out


@pytest.mark.parametrize("bold", [False, True])
def test_gram_descent_equals_direct_descent(spark, bold):
    rng = np.random.RandomState(0)
    X = rng.normal(size=(200, 3)) * [1.0, 2.0, 0.5] + [3.0, -1.0, 2.0]
    y = X @ [1.5, -2.0, 0.7] + 4.0 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)], "a double, b double, c double, y double")
    got = linear.gd_history(linear.gram_stats(df, ["a", "b", "c"], "y"), 0.01, 25, bold_driver=bold)
    want = _direct(X, y, 0.01, 25, bold)
    for g, w in zip(got, want):
        assert g[0] == w[0]
        assert np.allclose(g[1:], w[1:], rtol=1e-9, atol=1e-9)


def test_init_parameters_not_shared(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0)], "x double, y double")
    st = linear.gram_stats(df, ["x"], "y")
    assert linear.gd_history(st, 1e-3, 3) == linear.gd_history(st, 1e-3, 3)


def test_descent_history_frame(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    h = linear.gradient_descent(df, ["x"], "y", rate=0.05, steps=200)
    last = h.orderBy("iter", ascending=False).first()
    assert last.cost < 1e-3 and last.m1 == pytest.approx(2.0, abs=0.05)
