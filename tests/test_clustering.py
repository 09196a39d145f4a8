import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector

from tessera.operators import clustering


def _points(spark, seed=0):
    rng = np.random.RandomState(seed)
    rows = []
    for c, centre in enumerate([(0, 0, 0), (5, 5, 0), (0, 6, 3)]):
        for _ in range(25):
            rows.append((len(rows), (np.array(centre) + rng.normal(size=3)).tolist(), c))
    return spark.createDataFrame(rows, "id long, x array<double>, c int")


def test_silhouette_equals_evaluator(spark):
    df = _points(spark)
    mine = clustering.silhouette(df, "x", "c").first().silhouette
    vec = df.select(array_to_vector("x").alias("features"), df.c.cast("double").alias("prediction"))
    assert mine == pytest.approx(ClusteringEvaluator().evaluate(vec), abs=1e-12)


def test_single_point_cluster_scores_zero(spark):
    df = spark.createDataFrame([(0, [0.0], 0), (1, [0.1], 0), (2, [5.0], 1)], "id long, x array<double>, c int")
    # point 2 is alone: s = 0; points 0, 1: a = 0.01, b = 25 / 24.01 -> 1 - a / b
    a0, b0 = 0.01, 25.0
    a1, b1 = 0.01, 24.01
    want = ((1 - a0 / b0) + (1 - a1 / b1) + 0.0) / 3
    assert clustering.silhouette(df, "x", "c").first().silhouette == pytest.approx(want)


def test_nearest_centre_matches_numpy(spark):
    df = _points(spark, 1)
    pts = {r.id: np.array(r.x) for r in df.collect()}
    centres = [pts[i] for i in sorted(pts)[:3]]
    want = {i: int(np.argmin([np.sum((p - c) ** 2) for c in centres])) for i, p in pts.items()}
    got = {r.id: r.prediction for r in clustering.nearest_centre(df, "id", "x", 3).collect()}
    assert got == want


def test_hash_split_is_stable(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    a = {r.k: r.s for r in df.select("k", clustering.hash_split("k").alias("s")).collect()}
    b = {r.k: r.s for r in df.repartition(7).select("k", clustering.hash_split("k").alias("s")).collect()}
    assert a == b and 0.55 < sum(v == "train" for v in a.values()) / 200 < 0.85


def test_cluster_summary(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "c int, v double")
    got = [tuple(r) for r in clustering.cluster_summary(df, "c", "v").collect()]
    assert got[0][:4] == (0, 1.0, 3.0, 2.0) and got[0][4] == pytest.approx(2 ** 0.5) and got[1][4] is None


def test_mixture_against_plain_em(spark):
    rng = np.random.default_rng(1)
    rows = [(3 * i + c, float(10 * c + rng.normal()), float(-7 * c + 2 * rng.normal())) for i in range(60) for c in range(3)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    m, history = clustering.mixture_fit(df, ["x", "y"], "id", 3, 4)
    x = np.array([r[1:] for r in rows])
    w, mu = np.full(3, 1 / 3), x[:3].copy()
    cov = np.repeat((np.cov(x.T, bias=True) + clustering.MIXTURE_RIDGE * np.eye(2))[None], 3, 0)
    want = []
    for _ in range(4):
        parts = np.stack([a * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - u, np.linalg.inv(s), x - u)) / (2 * np.pi * np.sqrt(np.linalg.det(s)))
                          for a, u, s in zip(w, mu, cov)], 1)
        want.append(np.log(parts.sum(1)).mean())
        r = parts / parts.sum(1, keepdims=True)
        w, mu = r.mean(0), (r.T @ x) / r.sum(0)[:, None]
        cov = np.stack([(r[:, c, None] * (x - mu[c])).T @ (x - mu[c]) / r[:, c].sum() + clustering.MIXTURE_RIDGE * np.eye(2) for c in range(3)])
    assert np.allclose(history, want) and sorted(history) == history
    assert np.allclose(m.weights, w) and np.allclose(m.means + m.origin, mu) and np.allclose(m.covariances, cov)
    best = np.stack([np.log(a) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * np.einsum("ni,ij,nj->n", x - u, np.linalg.inv(s), x - u)
                     for a, u, s in zip(w, mu, cov)], 1).argmax(1)
    assert [r.prediction for r in m.predict(df, ["x", "y"]).orderBy("id").collect()] == best.tolist()


def test_silhouettes_of_many_clusterings(spark, monkeypatch):
    rows = [(float(i), g, (i // (4 + g)) % 3) for g in (0, 1) for i in range(24)]
    df = spark.createDataFrame(rows, "x double, g int, p int").selectExpr("array(x) x", "g", "p")
    each = {r.g: r.silhouette for r in clustering.silhouettes(df, "x", "p", ["g"]).collect()}
    for g in (0, 1):
        assert each[g] == pytest.approx(clustering.silhouette(df.where(df.g == g), "x", "p").first()[0])
    monkeypatch.setattr(clustering, "MAX_CLUSTERS", 2)
    with pytest.raises(ValueError, match="clusters"):
        clustering.silhouette(df, "x", "p")


def test_clusterings_meet_only_their_own_clusters(spark):
    """Sums are joined by clustering, null names too, not searched through for every point."""
    rows = [(float(i), g, (i // 4) % 3) for g in (0, None) for i in range(24)]
    df = spark.createDataFrame(rows, "x double, g int, p int").selectExpr("array(x) x", "g", "p")
    out = clustering.silhouettes(df, "x", "p", ["g"])
    want = clustering.silhouette(df.where("g = 0"), "x", "p").first()[0]
    assert {r.g: r.silhouette for r in out.collect()} == {0: pytest.approx(want), None: pytest.approx(want)}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_points_of_a_fit_are_dealt_to_all_cores(spark, monkeypatch):
    from tessera import session
    one = spark.range(100).coalesce(1)
    assert session.dealt(one) is one
    monkeypatch.setattr(session, "TASK_ROWS", 30)
    many = session.dealt(one)
    sizes = many.rdd.glom().map(len).collect()
    assert len(sizes) == 4 and sum(sizes) == 100 and max(sizes) <= 30
