"""Packing along a space-filling curve.

Every document's tokens are hashed into a vector, the vector is projected to a
few dimensions, and the cell it falls in has a place on a Hilbert curve.  The
documents are range-sorted by that place, laid end to end, and cut every
``length`` tokens, so a sequence holds neighbours on the curve and only the last
sequence of the corpus is not full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import bounded, id_key, id_of, text_key
from tessera.llm.word_bpe import SLICE, Vocabulary
from tessera.session import checkpoint

BUCKETS = 256           # entries of a hashed document vector
DIMENSIONS = 4
BITS = 10               # cells per dimension: 2 ** BITS
HELD_TOKENS = 1 << 20   # tokens of pieces that a task holds, or makes of one row
SPREAD = 6.0            # standard deviations of a projection that the cells span, half to each side


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer cells ``(n, dimensions)``, by
    transposing the axes (Gray code and rotations, highest bit first)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


_PROJECTION = np.random.default_rng(7).choice([-1.0, 1.0], (BUCKETS, DIMENSIONS))


def curve_keys(token_lists: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document's tokens.  The hashed counts are damped by a
    square root and scaled to length 1, so a projection has variance 1 / BUCKETS
    x BUCKETS = 1 whatever the document's length; no token gives the middle cell."""
    vectors = np.zeros((len(token_lists), BUCKETS))
    for row, ids in zip(vectors, token_lists):
        if len(ids):
            row += np.bincount((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS)
    np.sqrt(vectors, out=vectors)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    place = vectors / np.where(norm > 0, norm, 1) @ _PROJECTION
    cells = np.clip(np.floor((place / SPREAD + 0.5) * (1 << BITS)), 0, (1 << BITS) - 1)
    return hilbert_key(cells.astype(np.int64))


def tokenise(docs: DataFrame, vocabulary: Vocabulary, *, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``(d, h, key, n, ids)`` per document: identity, curve key, number of
    tokens and the ids (``end_id`` last) as little-endian integers."""
    def run(batches):
        bpe = vocabulary.tokenizer()
        end = np.array([end_id], bpe.dtype).tobytes()
        for batch in bounded(batches, 2, SLICE):
            coded = [c + end for c in bpe.encode_all(batch.column(2).to_pylist())]
            ids = [np.frombuffer(c, bpe.dtype) for c in coded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(curve_keys(ids)), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array(coded, pa.binary())], ["d", "h", "key", "n", "ids"])

    return docs.select(id_key(id_col).alias("d"), text_key(text_col).alias("h"), F.col(text_col).alias("t")).mapInArrow(
        run, "d long, h long, key long, n long, ids binary")


def token_positions(sizes: DataFrame) -> DataFrame:
    """``(d, h, copies, at)``: where each document of ``sizes(d, h, key, n)``
    begins when all are laid end to end along the curve.  Rows that share d and
    h are copies of one document and lie behind one another.

    Range partitions are summed (a number each comes to the driver) and every
    partition then runs on from the sum of those before it.
    """
    one = sizes.groupBy("d", "h").agg(F.min("key").alias("key"), F.min("n").alias("n"), F.count("*").alias("copies"))
    ordered = checkpoint(one.repartitionByRange("key", "d", "h").sortWithinPartitions("key", "d", "h"))
    sums = {r["p"]: r["s"] for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(F.col("n") * F.col("copies")).alias("s")).collect()}
    begins, total = {}, 0
    for p in sorted(sums):
        begins[p], total = total, total + sums[p]

    def run(batches):
        from pyspark import TaskContext
        at = begins.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            n = batch.column(2).to_numpy() * batch.column(3).to_numpy()
            ends = at + n.cumsum()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(ends - n)],
                                             ["d", "h", "copies", "at"])
            at = int(ends[-1]) if len(ends) else at

    return ordered.select("d", "h", "n", "copies").mapInArrow(run, "d long, h long, copies long, at long")


def pack(docs: DataFrame, vocabulary: Vocabulary, *, length: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces ``(id, start, length, ids, doc_tokens, sequence_id, offset)`` of all
    documents, packed into sequences of ``length`` tokens.

    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone.  Every id lies in exactly one piece, sequences have no gaps, and only
    the last one of the corpus can be short, so padding is less than ``length``
    tokens in all.  ``ids`` are little-endian unsigned 32-bit integers.  Rows
    with a null id are packed too; repeated rows are packed each.  An empty
    table gives no pieces.
    """
    kind = docs.schema[id_col].dataType
    coded = checkpoint(tokenise(docs, vocabulary, end_id=end_id, id_col=id_col, text_col=text_col))
    places = token_positions(coded.select("d", "h", "key", "n"))
    # one row of a repeated document stands for its copies
    ids = coded.select("d", "h", "ids")
    many = places.where("copies > 1").select("d", "h")
    repeated = not many.isEmpty()
    if repeated:
        ids = ids.join(many, ["d", "h"], "left_anti").union(ids.join(many, ["d", "h"], "left_semi").dropDuplicates(["d", "h"]))
    wide = vocabulary.tokenizer().dtype

    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3

    def run(batches):
        cols: list[list] = [[] for _ in kinds]
        held = 0
        for batch in bounded(batches, 1):
            for d, raw, copies, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                tokens = np.frombuffer(raw, wide).astype("<u4")
                for begin in range(at, at + copies * len(tokens), len(tokens)):
                    start = 0
                    while start < len(tokens):
                        offset = (begin + start) % length
                        size = min(length - offset, len(tokens) - start)
                        for col, v in zip(cols, (d, start, size, tokens[start:start + size].tobytes(), len(tokens),
                                                 (begin + start) // length, offset)):
                            col.append(v)
                        start += size
                        held += size
                        if held > HELD_TOKENS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
                            cols, held = [[] for _ in kinds], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    names = ["d", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    placed = ids.join(places, ["d", "h"]).select("d", "ids", "copies", "at")
    if repeated:            # many copies of a document are dealt by ranges to all tasks
        n = (F.octet_length("ids") / wide.itemsize).cast("long")
        step = F.greatest(F.lit(1), F.floor(F.lit(HELD_TOKENS) / n)).cast("long")
        first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, step)).alias("c")
        ranges = placed.where(F.col("copies") > step).select("d", "ids", "copies", "at", first).select(
            "d", "ids", F.least(step, F.col("copies") - F.col("c")).alias("copies"), (F.col("at") + F.col("c") * n).alias("at"))
        placed = placed.where(F.col("copies") <= step).union(ranges.repartition("at"))
    out = placed.mapInArrow(run, "d long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.select(id_of("d", kind).alias(id_col), *names[1:])
