"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates lie in shards; a shard keeps, for every dimension, its rows sorted
by that component.  For a query the lists are read in parallel from their best
end (the largest component where the query's is positive, the smallest where it
is negative), every row met is scored exactly, and the scan stops as soon as the
bound, the score of an imaginary row that has the current component of every
list, is below the k-th best score.  Queries come in blocks and every block
meets every shard once; the k best of each shard are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

SHARD_ROWS = 8_192      # candidates in a shard, on average
BLOCK_ROWS = 512        # queries in a block, on average
MAX_TASKS = 50_000
SCALE = 256
STEP = 8                # list entries read per dimension before the bound is checked again
EXACT = 2 ** 53         # below, sums of products are exact in floating point


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)``: floor(256 x) of every component x as a double.  Rows whose
    id or vector is null, or whose vector holds a null, NaN or infinite component, are left out."""
    wide = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(wide, lambda x: F.floor(x * F.lit(float(SCALE))).cast("long")).alias("v")))


class Shard:
    """Rows of one shard with their sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.lists = np.argsort(self.rows, axis=0, kind="stable")       # per dimension, ascending
        self.largest = int(np.abs(self.rows).max(initial=0))

    def top(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than the query's own id:
        higher scores first, equal scores by the smaller id."""
        n, dims = self.rows.shape
        used = np.flatnonzero(q)
        fits = int(np.abs(q).max(initial=0)) * self.largest * max(1, dims) < EXACT
        rows, weights = (self.rows, q) if not fits else (self.rows.astype(np.float64), q.astype(np.float64))
        up = q[used] > 0
        seen = np.zeros(n, bool)
        scores = np.zeros(n, rows.dtype)
        kth, depth, step = None, 0, STEP
        while depth < n and len(used):
            upto = min(n, depth + step)
            forward, backward = self.lists[depth:upto, used[~up]], self.lists[n - upto:n - depth, used[up]]
            met = np.zeros(n, bool)
            met[forward] = True
            met[backward] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            scores[new] = rows[new] @ weights
            depth, step = upto, 2 * step
            own = self.ids[seen] == query_id
            got = scores[seen][~own]
            if len(got) >= k:
                kth = np.partition(got, len(got) - k)[len(got) - k]
                at = np.where(up, self.lists[n - depth, used], self.lists[depth - 1, used])
                bound = (rows[at, used] * weights[used]).sum()
                if bound < kth:         # an unseen row that ties could still have the smaller id
                    break
        else:
            rest = np.flatnonzero(~seen)
            scores[rest] = rows[rest] @ weights
            seen[rest] = True
        at = np.flatnonzero(seen & (self.ids != query_id))
        if kth is not None:
            at = at[scores[at] >= kth]
        best = at[np.lexsort((self.ids[at], -scores[at]))[:k]]
        return self.ids[best], scores[best].astype(np.int64)


def _unpacked(members: pa.StructArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and vectors of a packed shard or block."""
    vectors = members.field("v")
    ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
    return members.field("id").to_numpy(zero_copy_only=False), np.split(
        vectors.flatten().to_numpy(zero_copy_only=False), ends[:-1])


def _matrix(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    if all(len(v) == dims for v in vectors):
        return np.stack(vectors).astype(np.int64)
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: for every row of ``queries`` the ``k``
    rows of ``vectors`` with the highest integer inner product (all, if there
    are fewer) but those with the query's own id; ties to the smaller id.

    Components are quantised as in ``quantised``, whose left-out rows are
    neither queries nor candidates.  A shorter vector counts as padded with
    zeros.  Rows that repeat id and vector count once.  Products must fit in a
    long.  Other columns are not read; empty tables give no rows.

    The numbers of shards and blocks follow the numbers of rows, so a task
    holds one shard and one block whatever the size; every (block, shard) pair
    is one group, which is the stated query set against all rows, in blocks.
    """
    base = quantised(vectors, id_col, vec_col).distinct()
    asked = quantised(queries, id_col, vec_col).distinct()
    n, nq = base.count(), asked.count()
    shards, blocks = -(-n // SHARD_ROWS) or 1, -(-nq // BLOCK_ROWS) or 1
    # dealt by id and vector: an id that many vectors share is in all shards
    rows = base.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    # shards and blocks are packed into a row each (bounded); the blocks, a small part of the rows, meet every shard
    tasks = min(4 * shards, MAX_TASKS)      # by number: a task's time goes with its shards, not with their bytes
    packed = rows.repartition(tasks, "shard").groupBy("shard").agg(F.collect_list(F.struct("id", "v")).alias("members"))
    packed_q = asked.groupBy(F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(blocks)).cast("int").alias("block")).agg(
        F.collect_list(F.struct("id", "v")).alias("asked"))
    each = packed_q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(tasks, "shard")
    pairs = each.join(packed, "shard")

    def search(batches):
        for batch in batches:
            for members, block in zip(batch.column(0), batch.column(1)):
                ids, vectors = _unpacked(members.values)
                query_ids, query_vectors = _unpacked(block.values)
                dims = max(map(len, vectors + query_vectors))
                shard = Shard(ids, _matrix(vectors, dims))
                found = [shard.top(i, q, k) for i, q in zip(query_ids.tolist(), _matrix(query_vectors, dims))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, [len(f[0]) for f in found])),
                     pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                    ["query_id", "id", "score"])

    found = pairs.select("members", "asked").mapInArrow(search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
