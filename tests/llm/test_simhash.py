import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import connected_components
from tests.llm.brute import NULL, components, order_key


def plain(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def clusters(n=900, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    near = base[rng.integers(0, 40, n)]
    for _ in range(4):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate((base, near, np.zeros(1, np.uint64))))


@pytest.mark.parametrize("text", ["", None, "a", "A b C d", "a b c d e f a b c d", "é\xa0É x y z", "w " * 40000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 6])
def test_slices_cover_and_bound(bits):
    parts = simhash.slices(bits)
    assert sum(bin(m).count("1") for m, _ in parts) == 64 and sum(m for m, _ in parts) == 2 ** 64 - 1
    assert sum(r + 1 for _, r in parts) >= bits + 1         # differences that exceed every slice's reach exceed the bits


def test_every_link_meets_in_a_shard():
    fp = clusters()
    rng = np.random.default_rng(1)
    pairs = {(a, b) for a, b in np.argwhere(np.triu(simhash.distance(fp[:, None], fp[None, :]) <= 4, 1)).tolist()}
    met = set()
    for mask, reach in simhash.slices(4):
        points, radii = simhash.fit_tree(rng.permutation(fp)[:200] & np.uint64(mask), 4, reach)
        row, leaf, home = simhash.leaves(fp & np.uint64(mask), points, radii, reach)
        assert home.sum() == len(fp)
        at = {(r, x): h for r, x, h in zip(row.tolist(), leaf.tolist(), home.tolist())}
        for a, b in pairs:
            shared = [x for x in range(16) if (a, x) in at and (b, x) in at and (at[a, x] or at[b, x])]
            if shared:
                met.add((a, b))
    assert met == pairs


def test_links_and_blocks(spark, monkeypatch):
    fp = clusters(400, 3).view(np.int64)
    want = components(fp.view(np.uint64).tolist(), lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for n, c in want.items():
        groups.setdefault(c, set()).add(int(np.uint64(n).view(np.int64)))
    frame = spark.createDataFrame([(int(x),) for x in fp], "fp long")
    for shard, block in ((64, 1 << 18), (8, 32)):
        monkeypatch.setattr(simhash, "SHARD", shard)
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {}
        for r in connected_components(simhash.links(frame, 4)).collect():
            got.setdefault(r.component, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_documents(docs, corpus, empty):
    ids = sorted({(order_key(r[0]), plain(r[1])) for r in corpus})
    comp = components(ids, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    rows = simhash.near_duplicates(docs.withColumnRenamed("lang", "fp").withColumnRenamed("source", "d")).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        k = (order_key(r.doc_id), int(r.fingerprint, 16))
        low = comp[k][0]
        assert k in comp and r.component_id == (None if low == NULL else low)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(order_key(r.doc_id) for r in kept.collect()) == sorted({c[0] for c in comp.values()})
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(1001, 1200)] + [(7, 7), (3, 4), (4, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 1000 for k in range(1000, 1200)}}
