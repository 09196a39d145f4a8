"""Checks of fitted models: objectives against finite differences, a forest's votes, damaged models are told."""
import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import fitcheck


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 3)) * [1, 5, 0.2]
    y = (x[:, 0] + 0.1 * x[:, 1] > rng.normal(size=90) * 0.3).astype(float) + (x[:, 2] > 0.2)
    made = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(3, [0, 1, 2], v), *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(made, ["id", "features", "a", "b", "c", "label"])


@pytest.mark.parametrize("kind", ["logistic", "hinge", "softmax"])
def test_objective_and_gradient(rows, kind):
    two = rows if kind == "softmax" else rows.withColumn("label", (F.col("label") > 0).cast("double"))
    rng = np.random.default_rng(0)
    w, b = rng.normal(size=(3 if kind == "softmax" else 1, 3)), rng.normal(size=3 if kind == "softmax" else 1)
    x = np.array([r.features.toArray() for r in two.collect()])
    y = np.array([r.label for r in two.collect()])

    def plain(w, b):
        m = x @ w.T + b
        if kind == "softmax":
            return np.mean(np.log(np.exp(m).sum(1)) - m[np.arange(len(y)), y.astype(int)])
        s = (2 * y - 1) * m[:, 0]
        return np.mean(np.log1p(np.exp(-s))) if kind == "logistic" else np.mean(np.maximum(0, 1 - s))

    value, grad = fitcheck.objective(two, kind, w, b)
    assert value == pytest.approx(plain(w, b))
    for k in range(len(w)):
        for j in range(4):
            step = np.zeros((len(w), 4))
            step[k, j] = 1e-6
            up, down = (plain(w + s * step[:, :3], b + s * step[:, 3]) for s in (1, -1))
            assert grad[k, j] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_fits_hold_and_damage_shows(rows):
    two = rows.withColumn("label", (F.col("label") > 0).cast("double"))
    for data, kind, est in ((two, "logistic", LogisticRegression(maxIter=200, tol=1e-10)), (two, "hinge", LinearSVC()),
                            (rows, "softmax", LogisticRegression(maxIter=300, tol=1e-10))):
        model = est.fit(data)
        found = fitcheck.optimality(data, kind, model)
        assert found["objective_matches"] and found["gradient_share"] < (0.05 if kind == "hinge" else 1e-3)
        w, b = ((model.coefficientMatrix.toArray(), model.interceptVector.toArray()) if kind == "softmax" else
                (model.coefficients.toArray(), [model.intercept]))
        pred = model.transform(data).select("prediction", "features")
        assert fitcheck.recomputed(pred, w, b).where("prediction <> recomputed").count() == 0
        assert fitcheck.recomputed(pred, -np.asarray(w), b).where("prediction <> recomputed").count() > 0


def test_forest(spark, rows):
    model = RandomForestClassifier(numTrees=7, maxDepth=4, seed=3).fit(rows)
    nodes = fitcheck.forest_nodes(spark, model)
    assert nodes.select("tree").distinct().count() == 7 and fitcheck.unsound_nodes(nodes).isEmpty()
    votes = fitcheck.forest_votes(rows, nodes, "id", ["a", "b", "c"], 4)
    both = model.transform(rows).select("id", "prediction").join(votes, "id")
    assert both.count() == 90 and both.where("prediction <> voted").count() == 0
    moved = nodes.withColumn("threshold", F.col("threshold") + 1.0)
    assert model.transform(rows).join(fitcheck.forest_votes(rows, moved, "id", ["a", "b", "c"], 4), "id").where("prediction <> voted").count() > 0
    wrong = nodes.withColumn("stats", F.when(F.col("node") == 0, F.reverse("stats")).otherwise(F.col("stats")))
    assert not fitcheck.unsound_nodes(wrong.withColumn("gain", F.col("gain") + 0.01)).isEmpty()
