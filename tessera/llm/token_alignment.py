"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the
same bytes of a text, and how often each pair of ids meets in the corpus.

The texts are encoded once and the ids stored.  A first pass aligns them and
hands on each task's distinct pairs with their counts.  A minimal perfect hash
over the distinct pairs, in shards, gives every pair an index; counts go into
dense vectors by index, one a task and shard, which are summed as a tree.  A
second pass aligns the stored ids again and looks the counts up, each index
verified by the key that is stored at it.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tessera.llm import perfect_hash
from tessera.llm.common import bounded
from tessera.llm.word_bpe import _byte_alphabet
from tessera.session import scratch_path

SLICE = 1 << 20             # bytes of ids aligned at once
TEXT_SLICE = 2 << 20        # bytes of text encoded at once; a word that repeats there is encoded once
GROUP_CHARS = 100_000       # characters handed to a library at once
HELD_PAIRS = 1 << 21        # distinct pairs that a task holds before it hands them on
SHARD_PAIRS = 1 << 16       # distinct pairs in a shard, about
GROUP_ROWS = 1 << 20        # partial counts that become one vector, about
FAN = 16                    # vectors summed at a node of the tree
BLOCK_SHARDS = 64           # shards broadcast together: 4 million pairs, 64 MB

# Fixed value: how byte-level BPE splits a text before merging.
_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile("[\n!-~]+")
# Between a printable character, one blank and a printable character both vocabularies end a token.
_CUT = re.compile("(?<=[!-~]) (?=[!-~])")


def _pair(merge) -> tuple[str, str]:
    return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)


class Codec:
    """A byte-level BPE (A) and a sentencepiece model (B)."""

    def __init__(self, a_spec: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        value = {c: i for i, c in enumerate(_byte_alphabet())}
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # Merging the adjacent parts whose union has the lowest id is the same BPE if every entry comes of its own bytes; for
        # plain words a library that does just that is several times faster.
        added = self.a.get_added_tokens_decoder()
        entries = [(token, i) for token, i in vocab.items() if i not in added]
        merges = all(len(self.a.model.tokenize(token)) == 1 for token, _ in entries)
        ordered = [m[0] + m[1] for m in map(_pair, json.loads(a_spec)["model"]["merges"])]
        self.ranks = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks={self.a_bytes[i]: i for _, i in entries},
                                       special_tokens={}) if merges and [vocab[t] for t in ordered] == sorted(vocab[t] for t in ordered) else None
        self.tables = [pa.array(t, pa.binary()) for t in (self.a_bytes, self.b_bytes)]
        self.dtype = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")
        # a piece with a blank behind another character could reach over a cut
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def _ids_of_a(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of blank + word for all words, and how many each has.  Words that
        could be cut from a longer text are encoded as one, which saves a call each."""
        text = " " + " ".join(words)
        if self.ranks and _PLAIN.fullmatch(words[0]):           # and so are the others, see _groups
            ids = np.array(self.ranks.encode_ordinary(text), np.int64)
        else:
            ids = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        places = self.sizes[0][ids].cumsum()
        last = np.searchsorted(places, ends)
        if (places[last] == ends).all() and places[-1] == ends[-1]:
            return ids, np.diff(last, prepend=-1)
        each = [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        return np.array(list(chain.from_iterable(each)), np.int64), np.array([len(e) for e in each])

    def _learn(self, words: list[str]) -> tuple[list[bytes], list[bytes], list[str]]:
        """Ids of words by both vocabularies, and the words whose bytes one of them does not give back."""
        ids_a, n_a = self._ids_of_a(words)
        coded = self.b.encode(words, num_threads=1)
        n_b = np.array([len(x) for x in coded])
        ids_b = np.fromiter(chain.from_iterable(coded), np.int64, n_b.sum())
        out = []
        for ids, n in ((ids_a, n_a), (ids_b, n_b)):
            raw, ends = ids.astype(self.dtype).tobytes(), (n.cumsum() * self.dtype.itemsize).tolist()
            out.append([raw[i:j] for i, j in zip([0, *ends], ends)])
        want = (" " + " ".join(words)).encode()
        if all(want == t.take(pa.array(ids)).buffers()[2].to_pybytes() for t, ids in zip(self.tables, (ids_a, ids_b))):
            return *out, []
        return *out, [w for w, a, b in zip(words, *out)
                      if not b" " + w.encode() == self._spelled(a, self.a_bytes) == self._spelled(b, self.b_bytes)]

    def _groups(self, words: list[str]) -> Iterator[list[str]]:
        """The words by groups of about GROUP_CHARS, plain ones and others; a word
        that does not begin and end with a printable character is a group of its own."""
        groups, chars = {True: [], False: []}, {True: 0, False: 0}
        for word in words:
            if not ("!" <= word[0] <= "~" and "!" <= word[-1] <= "~" and self.cuts):
                yield [word]
                continue
            plain = _PLAIN.fullmatch(word) is not None
            groups[plain].append(word)
            chars[plain] += len(word)
            if chars[plain] > GROUP_CHARS:
                yield groups[plain]
                groups[plain], chars[plain] = [], 0
        yield from filter(None, groups.values())

    def _spelled(self, ids: bytes, table: list[bytes]) -> bytes:
        return b"".join([table[i] for i in np.frombuffer(ids, self.dtype).tolist()])

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of blank + text by A and of text by B, little-endian integers of
        ``dtype``; none for texts null, empty, or not spelled by their tokens."""
        cut = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        words = list({w for ws in cut for w in ws})
        known_a, known_b, odd = {}, {}, set()
        for group in self._groups(words):
            ids_a, ids_b, bad = self._learn(group)
            known_a.update(zip(group, ids_a))
            known_b.update(zip(group, ids_b))
            odd.update(bad)
        a = [b"".join(map(known_a.__getitem__, ws)) for ws in cut]
        b = [b"".join(map(known_b.__getitem__, ws)) for ws in cut]
        if odd:
            for i, ws in enumerate(cut):
                if not odd.isdisjoint(ws):
                    want = b" " + texts[i].encode()
                    if not want == self._spelled(a[i], self.a_bytes) == self._spelled(b[i], self.b_bytes):
                        a[i] = b[i] = b""
        return a, b


@lru_cache(maxsize=1)
def _codec(a_spec: str, b_model: bytes) -> Codec:
    return Codec(a_spec, b_model)


class Vocabularies:
    """The two vocabulary files, read on the driver and broadcast (2 MB, fixed by the files)."""

    def __init__(self, spark: SparkSession, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            files = a.read(), b.read()
        self._shared = spark.sparkContext.broadcast(files)
        codec = Codec(*files)
        self.dtype, self.sizes = codec.dtype, spark.sparkContext.broadcast(codec.sizes)
        self.n_b = len(codec.b_bytes)

    def codec(self) -> Codec:
        return _codec(*self._shared.value)


class Aligned:
    """The links of some texts: ``a`` and ``b`` hold the ids of each as bytes.

    All texts stand one behind the other.  The places where a token of either
    vocabulary ends cut the bytes into stretches; each lies in one token of A
    and one of B, and no two lie in the same two, so stretches are links.
    """

    def __init__(self, a: list[bytes], b: list[bytes], dtype: np.dtype, sizes: tuple[np.ndarray, np.ndarray]):
        self.a, self.b = (np.frombuffer(b"".join(x), dtype) for x in (a, b))
        self.n_a, self.n_b = (np.array([len(x) // dtype.itemsize for x in y], np.int64) for y in (a, b))
        ends = [size[ids].cumsum() for size, ids in zip(sizes, (self.a, self.b))]
        mark = np.zeros(ends[0][-1] + 1 if len(self.a) else 1, np.uint8)
        for bit, e in zip((1, 2), ends):
            mark[e] |= bit
        mark[0] = 0
        at = np.flatnonzero(mark)
        self.marks = mark[at]
        in_a, in_b = self.marks & 1, self.marks >> 1
        self.at_a, self.at_b = in_a.cumsum(dtype=np.int64) - in_a, in_b.cumsum(dtype=np.int64) - in_b
        last = self.n_a.cumsum()
        text_ends = np.append(0, ends[0])[last]
        self.link_ends = np.searchsorted(at, text_ends, "right")

    def pairs(self, n_b: int) -> np.ndarray:
        """The two ids of every link as one number."""
        return self.a[self.at_a].astype(np.int64) * n_b + self.b[self.at_b]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of the links' values in each text."""
        total = np.append(0, np.cumsum(values, dtype=np.int64))[np.append(0, self.link_ends)]
        return np.diff(total)

    def groups(self) -> tuple[np.ndarray, pa.Array]:
        """Number of groups of each text, and the groups written as ``a1,a2|b1;a3|b2,b3``."""
        both = self.marks == 3
        n = self.per_text(both)
        sides = []
        for ids, at, bit in ((self.a, self.at_a, 1), (self.b, self.at_b, 2)):
            names = pc.cast(pa.array(ids), pa.string())
            ends = at[both] + 1                    # a token of either side ends where both do
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, names), ","))
        each = pc.binary_join_element_wise(*sides, "|")
        offsets = pa.array(np.append(0, n.cumsum()).astype(np.int32))
        return n, pc.binary_join(pa.ListArray.from_arrays(offsets, each), ";")


def encode(docs: DataFrame, vocabularies: Vocabularies, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, a, b)``: the ids of every text by both vocabularies as binary."""
    def run(batches):
        codec = vocabularies.codec()
        for batch in bounded(batches, 1, TEXT_SLICE):
            a, b = codec.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["id", "a", "b"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, a binary, b binary")


def _aligned(batches, vocabularies: Vocabularies) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in bounded(batches, "a", SLICE):
        a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
        yield batch, Aligned(a, b, vocabularies.dtype, vocabularies.sizes.value)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return every, total


def partial_counts(coded: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """``(part, bucket, pair, n)``: the pairs of each task with the number of their links."""
    n_b = vocabularies.n_b

    def run(batches):
        part = TaskContext.get().partitionId()
        keys, counts, held, known = [], [], 0, 0

        def out():
            k, n = _summed(keys, counts)
            for at in range(0, len(k), 1 << 18):
                some = k[at:at + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), part, np.int32)), pa.array(perfect_hash.bucket(some)), pa.array(some),
                     pa.array(n[at:at + (1 << 18)])], ["part", "bucket", "pair", "n"])

        for _, texts in _aligned(batches, vocabularies):
            k, n = np.unique(texts.pairs(n_b), return_counts=True)
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > 2 * known + HELD_PAIRS // 4:      # sum up what came since
                k, n = _summed(keys, counts)
                keys, counts, held, known = [k], [n], len(k), len(k)
                if known > HELD_PAIRS:
                    yield from out()
                    keys, counts, held, known = [], [], 0, 0
        if keys:
            yield from out()

    return coded.select("a", "b").mapInArrow(run, "part int, bucket int, pair long, n long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _function(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(sizes, words, keys in the order of their index)``."""
    sizes, words = perfect_hash.build(keys)
    ordered = np.empty_like(keys)
    ordered[perfect_hash.Hash([(sizes, words)]).index(keys)] = keys
    return sizes, words, ordered


def _one_shard(function: pa.Table) -> perfect_hash.Hash:
    row = function.slice(0, 1).to_pylist()[0]
    # keys of one shard: whatever its number, the function is asked for no others
    return perfect_hash.Hash([(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], "<u8"))])


def pair_counts(partial: DataFrame) -> tuple[DataFrame, int]:
    """``(shard, sizes, words, keys, counts)`` a shard, and the number of
    shards: the hash function of the shard's distinct pairs, and by index the
    pair and the number of its links in the whole corpus."""
    rows, distinct = partial.agg(F.count(F.lit(1)), F.approx_count_distinct("pair")).first()
    shards = max(1, -(-distinct // SHARD_PAIRS))
    salts = max(1, -(-rows // (shards * GROUP_ROWS)))
    shard = F.pmod("bucket", F.lit(shards)).alias("shard")

    def build(group: pa.Table) -> pa.Table:
        sizes, words, keys = _function(group.column("pair").to_numpy())
        return pa.table({"shard": group.column("shard").slice(0, 1), "sizes": pa.array([sizes.tobytes()], pa.binary()),
                         "words": pa.array([words.tobytes()], pa.binary()), "keys": pa.array([keys.tobytes()], pa.binary())})

    functions = _stored(partial.select(shard, "pair").distinct().groupBy("shard").applyInArrow(
        build, "shard int, sizes binary, words binary, keys binary"), "pair-hash")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs, n = left.column("pair").to_numpy(), left.column("n").to_numpy()
        vector = np.zeros(len(right.column("keys")[0].as_py()) // 8, np.int64)
        np.add.at(vector, _one_shard(right).index(pairs), n)
        return pa.table({"shard": left.column("shard").slice(0, 1), "salt": left.column("salt").slice(0, 1),
                         "vector": pa.array([vector.tobytes()], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int64) for v in group.column("vector"))
        return pa.table({"shard": group.column("shard").slice(0, 1), "salt": group.column("node").slice(0, 1),
                         "vector": pa.array([total.tobytes()], pa.binary())})

    # a pair is in a task's rows once, or once each time the task handed its pairs on: salts by task and pair even them out
    dealt = partial.select(shard, F.pmod(F.xxhash64("part", "pair"), F.lit(salts)).cast("int").alias("salt"), "pair", "n")
    per_salt = functions.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    kind = "shard int, salt int, vector binary"
    vectors = dealt.groupBy("shard", "salt").cogroup(per_salt.groupBy("shard", "salt")).applyInArrow(
        lambda left, right: count(left, right) if left.num_rows else pa.table(
            {"shard": pa.array([], pa.int32()), "salt": pa.array([], pa.int32()), "vector": pa.array([], pa.binary())}), kind)
    while salts > 1:
        vectors = vectors.withColumn("node", F.floor(F.col("salt") / FAN).cast("int")).groupBy("shard", "node").applyInArrow(add, kind)
        salts = -(-salts // FAN)
    table = functions.join(vectors.select("shard", F.col("vector").alias("counts")), "shard")
    return _stored(table, "pair-counts"), shards


class _Block:
    """Counts of the pairs of neighbouring shards."""

    def __init__(self, rows: list, first: int, shards: int):
        parts = [(np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["words"], "<u8")) for r in rows]
        self.hash = perfect_hash.Hash(parts, first, shards)
        self.keys = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows])
        self.counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows])

    def add(self, pairs: np.ndarray, into: np.ndarray) -> None:
        """Put the counts of those pairs that are here into ``into``."""
        at = self.hash.index(pairs)
        here = at >= 0
        here[here] = self.keys[at[here]] == pairs[here]
        into[here] = self.counts[at[here]]


@lru_cache(maxsize=1)
def _loaded(shared) -> _Block:
    """One block is held per worker; the broadcast, which keeps what it read, is made to let go of it."""
    block = shared.value
    vars(shared).pop("_value", None)
    return block


class PairCounts:
    """The table of ``pair_counts`` as broadcast blocks of ``BLOCK_SHARDS``
    shards, collected one at a time, and each B id's highest count (a number
    per id of the vocabulary)."""

    def __init__(self, table: DataFrame, shards: int, n_b: int):
        def highest(batches):
            for batch in batches:
                best = np.zeros(n_b, np.int64)
                for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    np.maximum.at(best, np.frombuffer(keys, np.int64) % n_b, np.frombuffer(counts, np.int64))
                at = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(best[at])], ["b", "n"])

        sc = table.sparkSession.sparkContext
        best = np.zeros(n_b, np.int64)
        for r in table.select("keys", "counts").mapInArrow(highest, "b int, n long").groupBy("b").agg(F.max("n").alias("n")).collect():
            best[r["b"]] = r["n"]
        self.best = sc.broadcast(best)
        self.blocks = []
        for first in range(0, shards, BLOCK_SHARDS):
            rows = {r["shard"]: r for r in table.where(F.col("shard").between(first, first + BLOCK_SHARDS - 1)).collect()}
            none = {k: b"" for k in ("sizes", "words", "keys", "counts")}
            rows = [rows.get(s, none) for s in range(first, min(first + BLOCK_SHARDS, shards))]
            self.blocks.append(sc.broadcast(_Block(rows, first, shards)))

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """Count of each pair; a pair that the corpus does not have is an error."""
        out = np.zeros(len(pairs), np.int64)
        for shared in self.blocks:
            _loaded(shared).add(pairs, out)
        if len(out) and not out.min():
            raise ValueError("a pair without a count")
        return out


def align(docs: DataFrame, vocabularies: Vocabularies, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row of ``docs``.

    Links are the pairs of an A and a B token whose bytes overlap; a link's
    count is how many links of the whole corpus have its two ids; ``n_best``
    counts the links whose count is the highest of their B id, ties included.
    ``groups`` lists the ids between neighbouring places where both
    vocabularies end a token, as ``a1,a2|b1;a3|b2,b3``.

    Texts null, empty, or whose tokens spell other bytes than blank + text
    have no tokens: zeros and an empty ``groups``; they count nothing.
    Repeated rows each count and give equal rows; an empty table gives an
    empty one.  Other columns are not read, so their names cannot clash.
    """
    coded = _stored(encode(docs, vocabularies, id_col=id_col, text_col=text_col), "token-ids")
    partial = _stored(partial_counts(coded, vocabularies), "pair-partials")
    table, shards = pair_counts(partial)
    known = PairCounts(table, shards, vocabularies.n_b)
    n_b = vocabularies.n_b

    def run(batches):
        best = known.best.value
        for batch, texts in _aligned(batches, vocabularies):
            pairs, inverse = np.unique(texts.pairs(n_b), return_inverse=True)
            counts = known.of(pairs)
            top = counts == best[pairs % n_b]
            n, groups = texts.groups()
            numbers = [texts.n_a, texts.n_b, n, texts.per_text(np.ones(len(inverse), np.int64)), texts.per_text(top[inverse]),
                       texts.per_text(counts[inverse])]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("id")), *map(pa.array, numbers), groups],
                                             ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    kind = coded.schema["id"].dataType.simpleString()
    out = coded.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return out.withColumnRenamed("id", id_col)
