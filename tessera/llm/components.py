"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import checkpoint

MAX_ROUNDS = 60      # the rounds needed grow with the logarithm of the nodes


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)`` (longs); the
    component is the smallest node reachable.  Self loops and repeated edges
    are allowed; no edges give no rows.

    Each round is a pre-aggregated minimum per node and a join on the node, so
    a hub's edges are never collected; the minima are stored, which makes the
    join one of plain exchanges whose hubs Spark can split.
    """
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    own = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges = edges.where("u <> v")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = checkpoint(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError("connected_components did not settle")
    return own.join(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def _state(edges: DataFrame):
    """Changes whenever an edge does: a star hangs every node on one smaller node."""
    return tuple(edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")),
                           F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node hangs on the node's smallest neighbour or itself.  May repeat edges."""
    around = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
    low = checkpoint(around.groupBy("x").agg(F.min("y").alias("m")))
    return (around.where("y > x").join(low, "x")
            .select(F.col("y").alias("u"), F.least("x", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    low = checkpoint(edges.groupBy("u").agg(F.min("v").alias("m")))
    hung = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
