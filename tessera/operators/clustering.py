"""Clustering: spark.ml KMeans / GaussianMixture fits, the closed-form
silhouette, nearest-centre assignment, per-cluster statistics, splits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from tessera.session import checkpoint

MAX_CLUSTERS = 10_000       # rows of sums that every task of the silhouette holds
MIXTURE_RIDGE = 1e-6        # added to the variances of a mixture's components


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def _sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def cluster_sums(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """(cluster, n, s = element-wise sum of the vectors, q = sum of squared norms).
    Vector sums use spark.ml's Summarizer (JVM-side, partial per task)."""
    return (df.select(F.col(cluster).alias("cluster"), array_to_vector(F.col(vec)).alias("v"),
                      _dot(F.col(vec), F.col(vec)).alias("sq"))
            .groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col("v")).alias("s"), F.sum("sq").alias("q"))
            .select("cluster", "n", vector_to_array("s").alias("s"), "q"))


def silhouettes(df: DataFrame, vec: str, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., silhouette): mean silhouette with squared Euclidean distance of
    each clustering, in closed form; ``by`` tells several clusterings of the
    same or other points apart, which are all scored in one scan.

    The mean squared distance from x to the points of cluster C is
    |x|^2 + Q_C / n_C - 2 x.S_C / n_C, so only k x d sums are needed: they are
    aggregated once, counted (an error above MAX_CLUSTERS) and attached to every
    point by a scalar subquery, or a broadcast join by clustering; never pairwise distances.  Own-cluster
    dissimilarity is scaled by n/(n-1); a point alone in its cluster scores 0.
    """
    x = F.col(vec).cast("array<double>")
    pts = df.select(F.struct(F.lit(0), *by).alias("g"), F.col(cluster).alias("cluster"), x.alias("x"))
    stats = checkpoint(cluster_sums(pts.select(F.struct("g", "cluster").alias("c"), "x"), "x", "c").select(
        "cluster.g", "cluster.cluster", "n", "s", "q"))
    if (found := stats.count()) > MAX_CLUSTERS:
        raise ValueError(f"{found} clusters, more than {MAX_CLUSTERS}")
    clusters = F.collect_list(F.struct("cluster", "n", "s", "q"))
    if by:      # a clustering's own clusters only: at most MAX_CLUSTERS in all
        pts = pts.join(F.broadcast(stats.groupBy(F.col("g").alias("own_g")).agg(clusters.alias("t"))), F.col("g").eqNullSafe(F.col("own_g")))
    else:
        pts = pts.withColumn("t", stats.select(clusters).scalar())
    table = F.col("t")
    sq = _dot(F.col("x"), F.col("x"))

    def diss(c):
        return sq + c["q"] / c["n"] - F.lit(2.0) * _dot(F.col("x"), c["s"]) / c["n"]

    own = F.filter(table, lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.transform(F.filter(table, lambda c: c["cluster"] != F.col("cluster")), diss)
    a = diss(own) * own["n"] / (own["n"] - F.lit(1))
    b = F.array_min(others)
    s = (F.when(own["n"] <= 1, F.lit(0.0))
         .when(a < b, F.lit(1.0) - a / b)
         .when(a > b, b / a - F.lit(1.0))
         .otherwise(F.lit(0.0)))
    return pts.select("g", s.alias("s")).groupBy("g").agg(F.avg("s").alias("silhouette")).select(
        *[F.col("g")[c].alias(c) for c in by], "silhouette")


def silhouette(df: DataFrame, vec: str, cluster: str, digits: int | None = None) -> DataFrame:
    """One row, the mean silhouette of one clustering (null for no points); see ``silhouettes``."""
    out = silhouettes(df, vec, cluster).agg(F.max("silhouette").alias("silhouette"))
    return out.select(F.round("silhouette", digits).alias("silhouette")) if digits is not None else out


def nearest_centre(df: DataFrame, id_col: str, vec: str, k: int) -> DataFrame:
    """Assign every point to the nearest of k fixed centres (the first k rows
    by id; ties -> lower centre number): (id, prediction)."""
    x = F.col(vec).cast("array<double>")
    centres = (df.select(F.col(id_col), x.alias("c")).orderBy(id_col).limit(k))
    table = F.col("t")
    indexed = F.transform(table, lambda c, i: F.struct(c["c"].alias("c"), i.alias("i")))
    cand = F.transform(indexed, lambda c: F.struct(_sqdist(F.col("x"), c["c"]).alias("d"), c["i"].alias("i")))
    return (df.select(F.col(id_col), x.alias("x"))
            .withColumn("t", centres.select(F.sort_array(F.collect_list(F.struct(id_col, "c")))).scalar())
            .select(id_col, F.array_min(cand)["i"].alias("prediction")))


def cluster_summary(df: DataFrame, cluster: str, value: str) -> DataFrame:
    """Per cluster: min, max, mean, sample stddev of ``value``; ordered by cluster."""
    v = F.col(value).cast("double")
    return (df.groupBy(F.col(cluster).alias("cluster"))
            .agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"),
                 F.avg(v).alias("mean_value"), F.stddev_samp(v).alias("stddev_value"))
            .orderBy("cluster"))


def hash_split(key: str, train_tenths: int = 7) -> Column:
    """Portable, layout-independent split flag: first 8 hex digits of
    md5(key) as a number, modulo 10, below ``train_tenths`` -> train."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.when(h % 10 < train_tenths, F.lit("train")).otherwise(F.lit("test"))


def _array(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def _nearest(cols: Sequence[str], centres: dict[int, list[list[float]]]) -> Column:
    """array<struct<k, prediction>>: for each k the number of the nearest of its
    centres, the lower one on a tie.  All centres are one literal, so the
    expression does not grow with them."""
    def listed(of):
        return ", ".join(f"named_struct('i', {i}, 'c', array({', '.join(f'{float(v)!r}D' for v in c)}))" for i, c in enumerate(of))

    table = F.expr("array(" + ", ".join(f"named_struct('k', {int(k)}, 'centres', array({listed(of)}))" for k, of in centres.items()) + ")")
    far = lambda c: F.struct(_sqdist(F.col("x__"), c["c"]).alias("d"), c["i"].alias("i"))       # noqa: E731
    return F.transform(table, lambda t: F.struct(t["k"].alias("k"), F.array_min(F.transform(t["centres"], far))["i"].alias("prediction")))


def assign_all(df: DataFrame, cols: Sequence[str], centres: dict[int, list[list[float]]]) -> DataFrame:
    """``df`` once for each k of ``centres``, with ``k`` and ``prediction``, the number of the nearest centre."""
    each = df.withColumn("x__", _array(cols)).withColumn("each__", F.explode(_nearest(cols, centres)))
    return each.select(*df.columns, "each__.k", "each__.prediction")


def assign(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` with ``prediction``: the nearest centre, the lower number on a tie."""
    one = df.withColumn("x__", _array(cols)).withColumn("prediction", _nearest(cols, {0: list(centres)})[0]["prediction"])
    return one.select(*[c for c in df.columns if c != "prediction"], "prediction")


def lloyd_all(df: DataFrame, cols: Sequence[str], key: str, ks: Sequence[int], steps: int) -> dict[int, list[list[float]]]:
    """Centres of Lloyd's algorithm for every k of ``ks`` after ``steps`` steps
    from the first k rows by ``key``.  A step is one aggregate for all k
    together; a centre without points stays where it is.  Nothing depends on the
    rows' layout but the rounding of the sums."""
    first = [[float(v) for v in r] for r in df.orderBy(key).limit(max(ks)).select(*cols).collect()]
    centres = {k: first[:k] for k in ks}
    points = df.select(*cols)
    for _ in range(steps):
        means = assign_all(points, cols, centres).groupBy("k", "prediction").agg(*[F.avg(c).alias(c) for c in cols]).collect()
        centres = {k: [list(c) for c in of] for k, of in centres.items()}
        for r in means:
            centres[r["k"]][r["prediction"]] = [float(r[c]) for c in cols]
    return centres


def lloyd(df: DataFrame, cols: Sequence[str], key: str, k: int, steps: int) -> list[list[float]]:
    """Centres of ``lloyd_all`` for one k."""
    return lloyd_all(df, cols, key, [k], steps)[k]


class Mixture:
    """Gaussian mixture: weights (k), means (k, d) and covariances (k, d, d) of
    coordinates less ``origin``, so that sums of squares keep their digits."""

    def __init__(self, origin: np.ndarray, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray):
        self.origin, self.weights, self.means, self.covariances = origin, weights, means, covariances

    def columns(self, cols: Sequence[str]) -> tuple[list[Column], list[Column]]:
        """The shifted coordinates, and each component's ln(weight x density) at them."""
        y = [F.col(c).cast("double") - F.lit(float(o)) for c, o in zip(cols, self.origin)]
        logs = []
        for w, mean, cov in zip(self.weights, self.means, self.covariances):
            inverse, log_det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
            off = [c - F.lit(float(m)) for c, m in zip(y, mean)]
            quad = F.lit(0.0)
            for i, a in enumerate(off):
                for j, b in enumerate(off[:i + 1]):
                    quad = quad + a * b * F.lit(float(inverse[i, j] * (2 if j < i else 1)))
            front = (math.log(w) if w > 0 else -math.inf) - 0.5 * (len(cols) * math.log(2 * math.pi) + log_det)
            logs.append(F.lit(float(front)) - quad * 0.5)
        return y, logs

    def scored(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` with ``y`` (shifted coordinates), ``logs``, and ``log_density`` = ln of the sum of exp(logs)."""
        y, logs = self.columns(cols)
        out = df.withColumns({"y": F.array(*y), "logs": F.array(*logs)}).withColumn("top", F.array_max("logs"))
        total = F.aggregate("logs", F.lit(0.0), lambda s, v: s + F.exp(v - F.col("top")))
        return out.withColumn("log_density", F.col("top") + F.ln(total)).drop("top")

    def predict(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` with ``prediction``: the component of the highest weighted density, the lower number on a tie."""
        logs = self.columns(cols)[1]
        best = F.least(*[F.struct((-v).alias("d"), F.lit(i).alias("i")) for i, v in enumerate(logs)])["i"] if len(logs) > 1 else F.lit(0)
        return df.withColumn("prediction", best)


def mixture_start(df: DataFrame, cols: Sequence[str], key: str, k: int, ridge: float = MIXTURE_RIDGE) -> Mixture:
    """Equal weights, the first ``k`` rows by ``key`` as means, the covariance of all rows for each."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col(c).cast("double") for c in cols]
    row = df.agg(*[F.avg(c) for c in x], *[F.covar_pop(x[i], x[j]) for i, j in pairs]).first()
    origin, cov = np.array(row[:d], float), np.zeros((d, d))
    for (i, j), v in zip(pairs, row[d:]):
        cov[i, j] = cov[j, i] = v
    means = np.array([[float(v) for v in r] for r in df.orderBy(key).limit(k).select(*cols).collect()]) - origin
    return Mixture(origin, np.full(len(means), 1 / len(means)), means, np.repeat((cov + ridge * np.eye(d))[None], len(means), 0))


def mixture_step(df: DataFrame, cols: Sequence[str], mixture: Mixture, ridge: float = MIXTURE_RIDGE) -> tuple[Mixture, float]:
    """The mixture after one EM step, and the mean log-likelihood before it.

    One aggregate: for every component the sums of the responsibilities, of the
    coordinates and of their products, each weighted by the responsibility
    (k (1 + d + d (d + 1) / 2) numbers reach the driver).  ``ridge`` is added
    to the variances; a component that no row takes part in stays as it is.
    """
    d, k = len(cols), len(mixture.weights)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    rows = mixture.scored(df.select(*cols), cols).select(
        "log_density", *[F.col("y")[i].alias(f"y{i}") for i in range(d)],
        *[F.exp(F.col("logs")[c] - F.col("log_density")).alias(f"r{c}") for c in range(k)])
    sums = rows.agg(F.count(F.lit(1)), F.sum("log_density"), *[f for c in range(k) for f in (
        F.sum(f"r{c}"), *[F.sum(F.col(f"r{c}") * F.col(f"y{i}")) for i in range(d)],
        *[F.sum(F.col(f"r{c}") * F.col(f"y{i}") * F.col(f"y{j}")) for i, j in pairs])]).first()
    n, each = sums[0], np.array(sums[2:], float).reshape(k, 1 + d + len(pairs))
    means, covs = mixture.means.copy(), mixture.covariances.copy()
    for c in range(k):
        if each[c, 0] > 0:
            means[c] = each[c, 1:1 + d] / each[c, 0]
            for (i, j), v in zip(pairs, each[c, 1 + d:]):
                covs[c, i, j] = covs[c, j, i] = v / each[c, 0] - means[c, i] * means[c, j] + (ridge if i == j else 0.0)
    return Mixture(mixture.origin, each[:, 0] / n, means, covs), sums[1] / n


def mixture_fit(df: DataFrame, cols: Sequence[str], key: str, k: int, steps: int) -> tuple[Mixture, list[float]]:
    """EM from ``mixture_start``: the mixture after ``steps`` steps and the mean
    log-likelihood before each.  Nothing depends on the rows' layout but the
    rounding of the sums."""
    mixture, history = mixture_start(df, cols, key, k), []
    for _ in range(steps):
        mixture, before = mixture_step(df, cols, mixture)
        history.append(before)
    return mixture, history


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out)


def fit_predict(estimator, cols: Sequence[str], train: DataFrame, test: DataFrame):
    """Fit [VectorAssembler, estimator] on train; return (model, train_pred, test_pred)."""
    model = Pipeline(stages=[assembler(cols), estimator]).fit(train)
    return model, model.transform(train), model.transform(test)


def kmeans(k: int = 3, tol: float = 1e-4, seed: int = 10) -> KMeans:
    return KMeans(k=k, tol=tol, seed=seed)


def gmm(k: int = 3, tol: float = 1e-4, seed: int = 10) -> GaussianMixture:
    return GaussianMixture(k=k, tol=tol, seed=seed)


def k_sweep(train: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 10),
            tol: float = 1e-4, seed: int = 10, parallelism: int = 4) -> DataFrame:
    """Silhouette of KMeans and GaussianMixture fits for each k: (model, k, silhouette).

    Fits run ``parallelism`` at a time, as in spark.ml's own model selection;
    each row is then predicted by all models at once, and all clusterings are
    scored in one scan."""
    feats = assembler(cols).transform(train).select("features").persist()
    jobs = [(name, k, make(k, tol, seed)) for k in ks for name, make in (("kmeans", kmeans), ("gmm", gmm))]
    try:
        feats.count()
        with ThreadPool(parallelism) as pool:
            models = pool.map(inheritable_thread_target(lambda job: job[2].fit(feats)), jobs)
        rows = feats
        for i, model in enumerate(models):
            rows = model.setPredictionCol(f"p{i}").transform(rows).drop("probability")
        each = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(int(k)).alias("k"), F.col(f"p{i}").alias("prediction"))
                         for i, (name, k, _) in enumerate(jobs)])
        points = checkpoint(rows.select(vector_to_array("features").alias("x"), each.alias("each")))
    finally:
        feats.unpersist()
    return silhouettes(points.select("x", F.explode("each").alias("e")).select("x", "e.*"), "x", "prediction", ["model", "k"])
