"""Checks of fitted models from the rows alone: objective and gradient at the
emitted weights by one aggregate, predictions recomputed from the weights, a
forest replayed from its node table by joins."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import unwrap_udt

from tessera.session import scratch_path

INTERCEPT, TOTALS = -1, -2      # idx of the intercept's gradient; idx of the loss and the row count
BROADCAST_NODES = 100_000       # nodes of a forest: 10 MB


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, idx, value)`` of every stored cell of a batch of unwrapped vectors."""
    vectors = batch.column("v")
    kind, indices, values = (vectors.field(c) for c in ("type", "indices", "values"))
    n = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    row, value = np.repeat(np.arange(len(n)), n), pc.list_flatten(values).to_numpy()
    idx = np.arange(len(row)) - np.repeat(n.cumsum() - n, n)             # a dense vector's positions
    sparse = np.repeat(kind.to_numpy() == 0, n)
    idx[sparse] = pc.list_flatten(indices).to_numpy()
    return row, idx, value


def _margins(batch: pa.RecordBatch, weights: np.ndarray, intercepts: np.ndarray):
    row, idx, value = _cells(batch)
    each = [np.bincount(row, value * w[idx], batch.num_rows) + b for w, b in zip(weights, intercepts)]
    return row, idx, value, np.stack(each, 1)


def _loss(kind: str, margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of every row, and its derivative by each margin."""
    if kind == "softmax":
        top = margins.max(1, keepdims=True)
        e = np.exp(margins - top)
        p = e / e.sum(1, keepdims=True)
        at = np.arange(len(label)), label.astype(int)
        loss = np.log(e.sum(1)) + top[:, 0] - margins[at]
        p[at] -= 1
        return loss, p
    z = margins[:, 0]
    if kind == "logistic":
        return np.logaddexp(0, z) - label * z, (1 / (1 + np.exp(-z)) - label)[:, None]
    sign = 2 * label - 1
    inside = sign * z < 1
    return np.where(inside, 1 - sign * z, 0.0), np.where(inside, -sign, 0.0)[:, None]


def objective(rows: DataFrame, kind: str, weights: np.ndarray, intercepts: np.ndarray, *, features_col: str = "features",
              label_col: str = "label") -> tuple[float, np.ndarray]:
    """Mean loss of the rows at given weights, without a penalty, and its
    gradient as (classes, features + 1), the intercept last.

    ``kind``: ``logistic`` and ``hinge`` (labels 0 and 1, one row of weights), or
    ``softmax``.  Tasks hand on one partial of the size of the model, which
    Spark adds up.
    """
    shared = rows.sparkSession.sparkContext.broadcast((np.atleast_2d(weights), np.atleast_1d(intercepts)))

    def run(batches):
        w, b = shared.value
        grad, loss, n = np.zeros((len(w), w.shape[1] + 1)), 0.0, 0
        for batch in batches:
            row, idx, value, margins = _margins(batch, w, b)
            each, slope = _loss(kind, margins, batch.column("y").to_numpy())
            loss, n = loss + each.sum(), n + len(each)
            for k in range(len(w)):
                grad[k, :-1] += np.bincount(idx, value * slope[row, k], w.shape[1])
                grad[k, -1] += slope[:, k].sum()
        k, at = np.nonzero(grad)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(k, 0).astype(np.int32)), pa.array(np.append(np.where(at == w.shape[1], INTERCEPT, at), TOTALS).astype(np.int32)),
             pa.array(np.append(grad[k, at], loss)), pa.array(np.append(np.zeros(len(k), np.int64), n))], ["k", "idx", "g", "n"])

    sums = (rows.select(F.col(label_col).cast("double").alias("y"), unwrap_udt(F.col(features_col)).alias("v"))
            .mapInArrow(run, "k int, idx int, g double, n long").groupBy("k", "idx").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas())
    shared.destroy()
    totals = sums[sums["idx"] == TOTALS].iloc[0]
    shape = np.atleast_2d(weights).shape
    grad = np.zeros((shape[0], shape[1] + 1))
    rest = sums[sums["idx"] != TOTALS]
    grad[rest["k"].to_numpy(), rest["idx"].to_numpy()] = rest["g"].to_numpy()       # the intercept's -1 is the last column
    return totals["g"] / totals["n"], grad / totals["n"]


def recomputed(rows: DataFrame, weights: np.ndarray, intercepts: np.ndarray, *, features_col: str = "features") -> DataFrame:
    """``rows`` with ``recomputed``: the class of the highest margin (softmax), or 1 where the one margin is above 0."""
    shared = rows.sparkSession.sparkContext.broadcast((np.atleast_2d(weights), np.atleast_1d(intercepts)))
    names = [c for c in rows.columns if c != features_col]

    def run(batches):
        for batch in batches:
            m = _margins(batch, *shared.value)[3]
            found = m.argmax(1) if m.shape[1] > 1 else (m[:, 0] > 0).astype(int)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found.astype(float))], [*names, "recomputed"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select(*names, unwrap_udt(F.col(features_col)).alias("v")).mapInArrow(run, f"{kinds}, recomputed double")


def optimality(train: DataFrame, kind: str, model) -> dict:
    """Whether the objective recomputed from the rows is the one the fit ended
    with, and the largest entry of the gradient there as a share of the one at
    zero weights."""
    softmax = kind == "softmax"
    w = model.coefficientMatrix.toArray() if softmax else model.coefficients.toArray()
    b = model.interceptVector.toArray() if softmax else np.array([model.intercept])
    summary = model.summary() if callable(model.summary) else model.summary
    value, grad = objective(train, kind, w, b)
    _, start = objective(train, kind, np.zeros_like(w), np.zeros_like(b))
    return {"objective_matches": bool(abs(value - summary.objectiveHistory[-1]) <= 1e-9 * max(1.0, abs(value))),
            "gradient_share": float(np.abs(grad).max() / np.abs(start).max())}


def forest_nodes(spark: SparkSession, model) -> DataFrame:
    """Node table of a fitted random forest: (tree, node, feature, threshold,
    left, right, stats, impurity, gain); a leaf has left -1.  The model is saved
    in the shared folder and its nodes are read from there."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["impurityStats"].alias("stats"), n["impurity"].alias("impurity"), n["gain"].alias("gain"))


def forest_votes(rows: DataFrame, nodes: DataFrame, key: str, cols: Sequence[str], depth: int) -> DataFrame:
    """(key, voted): the class with the most votes of a forest of numeric splits.

    Every row starts at the root of every tree and goes down by one join with
    the node table a level; a leaf votes with its class shares.  Equal votes go
    to the lower class.  The node table is broadcast if it was counted to be small."""
    if nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    trees = nodes.select("tree").distinct()
    at = rows.select(key, F.array(*[F.col(c).cast("double") for c in cols]).alias("x")).crossJoin(F.broadcast(trees)).withColumn(
        "node", F.lit(0))                   # a row per tree of the model, a parameter
    step = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    for _ in range(depth):
        down = F.when(F.col("left") < 0, F.col("node")).when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(
            F.col("right"))
        at = at.join(step, ["tree", "node"]).select(key, "x", "tree", down.alias("node"))
    total = F.aggregate("stats", F.lit(0.0), lambda s, v: s + v)
    votes = at.join(nodes.select("tree", "node", "stats"), ["tree", "node"]).select(
        key, F.posexplode(F.transform("stats", lambda v: v / total)).alias("cls", "share"))
    summed = votes.groupBy(key, "cls").agg(F.round(F.sum("share"), 9).alias("share"))
    best = F.max_by("cls", F.struct("share", -F.col("cls")))
    return summed.groupBy(key).agg(best.cast("double").alias("voted"))


def unsound_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes whose Gini impurity or gain is not what their own and their children's class counts give."""
    total = F.aggregate("stats", F.lit(0.0), lambda s, v: s + v)
    gini = 1.0 - F.aggregate("stats", F.lit(0.0), lambda s, v: s + v * v) / (total * total)
    plain = nodes.withColumn("n", total).withColumn("gini", gini)
    child = plain.select("tree", F.col("node").alias("c"), F.col("n").alias("cn"), F.col("gini").alias("cg"))
    left, right = (child.select("tree", F.col("c").alias(side), F.col("cn").alias(f"{side}_n"), F.col("cg").alias(f"{side}_g"))
                   for side in ("left", "right"))
    joined = plain.join(left, ["tree", "left"], "left").join(right, ["tree", "right"], "left")
    gain = F.col("gini") - (F.col("left_n") * F.col("left_g") + F.col("right_n") * F.col("right_g")) / F.col("n")
    # a leaf that merged two children of one class, or never was split, has impurity -1
    wrong = ((F.col("impurity") >= 0) & (F.abs(F.col("gini") - F.col("impurity")) > 1e-9)) | ((F.col("left") >= 0) & (
        F.col("left_n").isNull() | F.col("right_n").isNull() | (F.abs(gain - F.col("gain")) > 1e-9)
        | (F.abs(F.col("left_n") + F.col("right_n") - F.col("n")) > 1e-6)))
    return joined.where(wrong).select("tree", "node")
