"""Linear regression: closed form and gradient descent.

Gradient descent runs on sufficient statistics.  One Spark aggregate
computes n, the means and the centred cross-product (Gram) matrix of the
features and the target (Spark's covariance aggregates are the numerically
stable streaming kind and combine partially per task).  Every step after
that is exact algebra on that (p+1) x (p+1) matrix:

    e      = y - m.x - b,  e_bar = mean_y - m.mean_x - b
    SSE    = Cyy - 2 m.Cxy + m'Cxx m + n e_bar^2
    sum xe = (Cxy - Cxx m) + mean_x n e_bar,  sum e = n e_bar

so 80 steps cost one pass over the data instead of 160.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType


def ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, slope m and intercept b of the least-squares line."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


@dataclass
class GramStats:
    n: float
    mean_x: list[float]
    mean_y: float
    cxx: list[list[float]]
    cxy: list[float]
    cyy: float


def gram_stats(df: DataFrame, xs: Sequence[str], y: str) -> GramStats:
    """n, means and centred cross products in one aggregate (one row to the driver)."""
    p = len(xs)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my")]
    aggs += [F.avg(x).alias(f"mx{i}") for i, x in enumerate(xs)]
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.covar_pop(xs[i], xs[j]).alias(f"c{i}_{j}"))
        aggs.append(F.covar_pop(xs[i], y).alias(f"c{i}_y"))
    aggs.append(F.var_pop(y).alias("cyy"))
    r = df.agg(*aggs).first().asDict()
    n = float(r["n"])
    cxx = [[0.0] * p for _ in range(p)]
    for i in range(p):
        for j in range(i, p):
            cxx[i][j] = cxx[j][i] = r[f"c{i}_{j}"] * n
    return GramStats(n=n, mean_x=[r[f"mx{i}"] for i in range(p)], mean_y=r["my"], cxx=cxx,
                     cxy=[r[f"c{i}_y"] * n for i in range(p)], cyy=r["cyy"] * n)


def gd_history(st: GramStats, rate: float, steps: int, init_m: Sequence[float] | None = None,
               init_b: float = 0.0, bold_driver: bool = False) -> list[tuple]:
    """Rows (iter, cost, m_1..m_p, b, rate).

    ``cost`` is the sum of squared errors of the parameters *before* the step;
    m, b and rate are the values after it.  With ``bold_driver`` the rate is
    multiplied by 1.05 when the cost fell below the previous one, else by 0.5.
    """
    p = len(st.mean_x)
    m = [0.0] * p if init_m is None else [float(v) for v in init_m]   # fresh list every call
    b, prev, n, rows = float(init_b), float("inf"), st.n, []
    for it in range(1, steps + 1):
        ebar = st.mean_y - sum(m[i] * st.mean_x[i] for i in range(p)) - b
        quad = sum(m[i] * sum(st.cxx[i][j] * m[j] for j in range(p)) for i in range(p))
        sse = st.cyy - 2.0 * sum(m[i] * st.cxy[i] for i in range(p)) + quad + n * ebar * ebar
        sxe = [(st.cxy[i] - sum(st.cxx[i][j] * m[j] for j in range(p))) + st.mean_x[i] * n * ebar
               for i in range(p)]
        m = [m[i] - rate * (-2.0 / n * sxe[i]) for i in range(p)]
        b = b - rate * (-2.0 / n * (n * ebar))
        if bold_driver:
            rate = rate * 1.05 if sse < prev else rate * 0.5
            prev = sse
        rows.append((it, sse, *m, b, rate))
    return rows


def gradient_descent(df: DataFrame, xs: Sequence[str], y: str, rate: float = 1e-4, steps: int = 80,
                     init_m: Sequence[float] | None = None, init_b: float = 0.0,
                     bold_driver: bool = False) -> DataFrame:
    """Training history as a DataFrame (iter, cost, m1..mp, b, rate)."""
    st = gram_stats(df, xs, y)
    rows = gd_history(st, rate, steps, init_m, init_b, bold_driver)
    p = len(xs)
    schema = StructType([StructField("iter", IntegerType())] + [StructField("cost", DoubleType())]
                        + [StructField(f"m{i + 1}", DoubleType()) for i in range(p)]
                        + [StructField("b", DoubleType()), StructField("rate", DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)
