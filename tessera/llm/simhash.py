"""SimHash near-duplicates: fingerprints, exact links through vantage-point trees, components.

The 64 bits are cut into ``max_bits`` slices.  Two fingerprints at most
``max_bits`` apart differ by at most 1 bit in the first, widest slice, or not
at all in one of the others (if every slice exceeded that, the differences
would add up to more).  Each slice has a vantage-point tree over its own
Hamming distance: an inner node holds a vantage point and a radius and sends a
fingerprint inside (distance at most the radius) or outside.  By the triangle
inequality two fingerprints at most r apart in the slice can only part where
one of them lies within r of the boundary, so every fingerprint lives in one
leaf (shard) and also visits the leaves across the boundaries it is that near
to.  Inside a shard the exact distance over all 64 bits decides.

The trees are fitted on a bounded sample (``SAMPLE`` fingerprints); they only
choose the shards, so links do not depend on the sample.  Their depth is
limited, for every level of the first tree adds a third to the visits, so a
fingerprint is shuffled a bounded number of times whatever the corpus.  Shards
larger than ``BLOCK`` are compared block against block in separate tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import free_name, id_key, id_of, small, text_batches, text_key
from tessera.llm.components import connected_components
from tessera.session import checkpoint

SAMPLE = 16_384         # fingerprints that shape the trees, whatever the corpus
SHARD = 64              # fingerprints a leaf should hold at home ...
DEPTHS = (12, 10)       # ... as far as the depth goes that a tree with reach 0 and 1 may have
BLOCK = 1 << 18         # fingerprints (8 bytes each) compared with each other in one task
HASHES = 1 << 15        # shingles held at once while a fingerprint is summed
BYTE_BITS = np.arange(256)[:, None] >> np.arange(8) & 1     # the bits of each byte value, lowest first

# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a whole text, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer
    words than a shingle is one shingle; one without words, or null, has
    fingerprint 0.  A bit is set if it is set in over half of the hashes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if n > 1 or len(words) == shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_digest        # big-endian bytes of the hash
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        h = b"".join([digest(joined[a:b], seed) for a, b in zip(first[at:at + HASHES], last[at:at + HASHES])])
        columns = np.frombuffer(h, np.uint8).reshape(-1, 8)[:, ::-1]
        ones += np.concatenate([np.bincount(columns[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(d, h, fp)`` per row of ``docs``: the row's identity and its fingerprint as a signed long."""
    def run(batches):
        for d, h, texts in text_batches(batches, "d", "h", "t"):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(h, pa.int64()), pa.array(fp)],
                                             ["d", "h", "fp"])

    return docs.select(id_key(id_col).alias("d"), text_key(text_col).alias("h"), F.col(text_col).alias("t")).mapInArrow(
        run, "d long, h long, fp long")


# ---------------------------------------------------------------- vantage-point trees


def slices(max_bits: int) -> list[tuple[int, int]]:
    """``(mask, reach)`` of the slices of the 64 bits; the first is half as wide again as the others."""
    n = max(1, max_bits)
    edges = [0, *(round(64 * (1.5 + i) / (n + 0.5)) for i in range(n))]
    return [(((1 << b) - 1) ^ ((1 << a) - 1), min(1, max_bits) if a == 0 else 0) for a, b in zip(edges, edges[1:])]


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b))


def fit_tree(sample: np.ndarray, depth: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree in heap order (node k has
    children 2k+1 inside and 2k+2 outside).  The radius is the one near the
    median that has the fewest sample points within ``reach`` of its boundary."""
    points, radii = np.zeros((1 << depth) - 1, np.uint64), np.zeros((1 << depth) - 1, np.int64)
    rows = {0: sample}
    for node in range((1 << depth) - 1):
        own = rows.pop(node)
        points[node] = own[node % len(own)] if len(own) else 0
        d = distance(own, points[node]).astype(np.int64)
        if len(own):
            counts = np.bincount(d, minlength=66)
            below = counts.cumsum()
            upto = np.concatenate((np.zeros(reach, int), below, np.full(reach, below[-1])))
            near = upto[2 * reach:] - upto[:len(below)]        # within (radius - reach, radius + reach]
            even = np.abs(below - len(own) / 2) / len(own)
            fit = np.where(even <= 0.25, near / len(own) + even, 10 + even)
            radii[node] = int(fit[:65].argmin())
        if 2 * node + 2 < len(points):
            rows[2 * node + 1], rows[2 * node + 2] = own[d <= radii[node]], own[d > radii[node]]
    return points, radii


def leaves(fp: np.ndarray, points: np.ndarray, radii: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """``(row, leaf, at_home)`` for every leaf that each fingerprint lives in or visits."""
    row, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
    for _ in range(int(np.log2(len(points) + 1))):
        d = distance(fp[row], points[node]).astype(np.int64) - radii[node]
        inside = d <= 0
        goes_in, goes_out = inside | (d <= reach), ~inside | (d > -reach)
        row = np.concatenate((row[goes_in], row[goes_out]))
        home = np.concatenate(((home & inside)[goes_in], (home & ~inside)[goes_out]))
        node = np.concatenate((2 * node[goes_in] + 1, 2 * node[goes_out] + 2))
    return row, node - len(points), home


def _shard_links(fp: np.ndarray, home: np.ndarray, sides: list[np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join whatever is linked between the two ``sides`` (masks over
    ``fp``, the same mask twice for a side with itself), at least one end at
    home: a breadth-first search over exact distances which lists one edge for
    each fingerprint it reaches, not all pairs of a cluster."""
    same = sides[0] is sides[1]
    left = [[fp[s & ~home], fp[s & home]] for s in (sides[:1] if same else sides)]     # not yet reached: visitors, home
    froms, tos = [], []
    for start in range(len(left)):
        while len(left[start][1]):
            root, left[start][1] = left[start][1][0], left[start][1][1:]
            queue = [(root, start, 1)]
            while queue:
                x, side, at_home = queue.pop()
                side = 0 if same else 1 - side
                for kind in range(1 - at_home, 2):
                    near = distance(left[side][kind], x) <= max_bits
                    if near.any():
                        hits, left[side][kind] = left[side][kind][near], left[side][kind][~near]
                        froms.append(np.full(len(hits), root))
                        tos.append(hits)
                        queue += [(h, side, kind) for h in hits]
    if not froms:
        return np.empty(0, fp.dtype), np.empty(0, fp.dtype)
    return np.concatenate(froms), np.concatenate(tos)


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints ``distinct(fp)`` that
    connect exactly what pairs of at most ``max_bits`` differing bits connect.

    Cliques of near copies come out as spanning edges, not as all their pairs.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    sample = np.array([r[0] for r in distinct.orderBy(F.xxhash64("fp", F.lit("sample")), "fp").limit(SAMPLE).collect()],
                      np.int64).view(np.uint64)
    wanted = max(0, (n // SHARD).bit_length())
    trees = spark.sparkContext.broadcast([
        (np.uint64(mask), reach, *fit_tree(sample & np.uint64(mask), min(DEPTHS[reach], wanted), reach))
        for mask, reach in slices(max_bits)])

    def place(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (mask, reach, points, radii) in enumerate(trees.value):
                row, leaf, home = leaves(fp & mask, points, radii, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), k, np.int32)), pa.array(leaf), pa.array(fp[row].view(np.int64)),
                     pa.array(home)], ["slice", "leaf", "fp", "home"])

    placed = distinct.select("fp").mapInArrow(place, "slice int, leaf long, fp long, home boolean")
    # Shards beyond BLOCK are cut into parts by hash; every pair of parts is a
    # task of its own.  The sizes are counted first (pre-aggregated).
    sizes = placed.groupBy("slice", "leaf").count()
    large = checkpoint(sizes.where(F.col("count") > BLOCK).select(
        "slice", "leaf", F.ceil(F.col("count") / F.lit(BLOCK // 2)).cast("long").alias("parts")))
    placed = placed.join(small(large), ["slice", "leaf"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp", F.lit("part")), "parts")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                        lambda j: F.struct(F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    dealt = placed.withColumn("part", part).withColumn("pair", F.explode(pairs)).select(
        "slice", "leaf", "pair.i", "pair.j", "part", "fp", "home")

    def search(key, rows):
        fp = rows["fp"].to_numpy().view(np.uint64)
        part, home = rows["part"].to_numpy(), rows["home"].to_numpy()
        one = part == key[2]
        a, b = _shard_links(fp, home, [one, one if key[2] == key[3] else part == key[3]], max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # by number: the work of a shard is in its comparisons, so small partitions are not to be joined by their bytes
    key = ["slice", "leaf", "i", "j"]
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key)
    return dealt.groupBy(*key).applyInPandas(search, "a long, b long").distinct()


# ---------------------------------------------------------------- documents


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the
    smallest id among the documents reachable over links of at most
    ``max_bits`` differing bits, itself included.  Null and wordless texts
    have fingerprint zero and link like any other; rows with a null id keep
    their fingerprint, and their component is its smallest other id (null if
    there is none).  Repeated rows are linked to each other.  An empty table
    gives no rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    fps, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    return fps.join(classes, "fp").select(
        id_of("d", kind).alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        id_of("low.d", kind).alias("component_id"))


def _classes(docs, id_col, text_col, shingle, max_bits) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows, and per distinct fingerprint the lowest row of its component."""
    fps = checkpoint(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    kinds = checkpoint(fps.groupBy("fp").agg(F.min(F.struct("d", "h")).alias("low")))
    nodes = connected_components(links(kinds.select("fp"), max_bits))
    group = kinds.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    lowest = group.groupBy("component").agg(F.min("low").alias("low"))
    # stored, so that the join on fp is between plain exchanges and a fingerprint of many copies can be split
    return fps, checkpoint(group.select("fp", "component").join(lowest, "component").select("fp", "low"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                         max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: the one
    with the smallest id (nulls last; the smaller text hash where rows share
    it), and one of it where the same row occurs more than once."""
    _, classes = _classes(docs, id_col, text_col, shingle, max_bits)
    d, h = free_name(docs, "d"), free_name(docs, "h")
    keep = classes.select(F.col("low.d").alias(d), F.col("low.h").alias(h)).distinct()
    keyed = docs.withColumns({d: id_key(id_col), h: text_key(text_col)})
    return keyed.join(keep, [d, h], "left_semi").dropDuplicates([d, h]).drop(d, h)
