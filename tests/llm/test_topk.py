import math
import random

import numpy as np
import pytest

from tessera.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def plain(rows, queries, k):
    ok = {(r[0], tuple(math.floor(256 * np.float32(x).astype(float)) for x in r[1])) for r in rows
          if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])}
    out = []
    for q, v in sorted(ok):
        if q in queries:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    return out


@pytest.mark.parametrize("shard,block", [(8192, 512), (16, 3)])
def test_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.1, -0.3, rng.uniform(-1, 1)]) for _ in range(rng.choice([6, 6, 6, 4]))], "x", 1)
            for i in range(120)]
    rows += [(200, None, "x", 1), (201, [1.0, None, 2.0], "x", 1), (202, [1.0, float("nan")], "x", 1), (203, [], "x", 1),
             (204, [float("inf")], "x", 1), (None, [1.0], "x", 1), (205, [0.0] * 6, "x", 1), rows[10], rows[10]]
    frame = spark.createDataFrame(rows, SCHEMA)
    asked = {i for i in range(0, 210, 5)}
    got = topk.top_k(frame, frame.where("vec_id % 5 = 0"), k=4)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, asked, 4)


def test_few_or_no_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0], "", 1), (1, [2.0], "", 1)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(frame, frame.where("vec_id = 0"), k=5).collect()] == [(0, 1, 1, 131072)]
    none = frame.limit(0)
    assert topk.top_k(none, none).count() == topk.top_k(frame, none).count() == topk.top_k(none, frame).count() == 0


def test_stops_early_and_large_numbers():
    rng = np.random.default_rng(0)
    rows = rng.integers(-50, 50, (3000, 4))
    rows[7] = 9000
    shard = topk.Shard(np.arange(3000), rows)
    q = np.array([3, 1, 2, 5])
    ids, scores = shard.top(-1, q, 1)
    assert ids.tolist() == [7] and scores.tolist() == [9000 * 11]
    big = topk.Shard(np.arange(3), np.array([[2 ** 30, 1], [2 ** 30, 0], [0, 1]]))
    assert big.top(9, np.array([2 ** 30, 1]), 2)[1].tolist() == [2 ** 60 + 1, 2 ** 60]


def test_many_vectors_under_one_id(spark, monkeypatch):
    """They are dealt to all shards, and the result is the brute-force one."""
    make = topk.Shard.__init__

    def counted(self, ids, rows):
        make(self, ids, rows)
        assert len(ids) < 400, "one group holds most vectors of the id"

    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk.Shard, "__init__", counted)
    rng = random.Random(6)
    rows = [(7, [rng.uniform(-1, 1), rng.uniform(-1, 1)], "", 1) for _ in range(1000)] + [(i, [rng.uniform(-1, 1), 0.5], "", 1) for i in range(100, 140)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(frame, frame.where("vec_id = 100"), k=5)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, {100}, 5)
