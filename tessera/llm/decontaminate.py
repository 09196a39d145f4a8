"""Benchmark decontamination: a broadcast hash set of the items' word windows,
and one scan of the documents against it.

The benchmark is normalised to words and cut into segments, which are dealt to
blocks of a measured size; the driver builds the hash set of one block at a
time and broadcasts it.  A task splits a slice of documents into words once,
looks every window up in each block's set, compares the words behind each hit
and marks the words that an occurrence covers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import bounded
from tessera.session import checkpoint

WINDOW = 10             # words
SEGMENT_WORDS = 2048    # words of an item that are indexed together
BLOCK_BYTES = 8 << 20   # text of a block; its index takes about ten times that
SLICE = 2 << 20         # bytes of documents scanned at once
PIECE = 1 << 20         # bytes of a text split into words at once

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
# A-Z in lower case, every byte that is in no word a blank; UTF-8 keeps all of a longer code point's bytes above 0x7F.
_PLAIN = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if _WORD[b] else 0x20 for b in range(256))
_FACTORS = np.random.default_rng(0).integers(1, 2 ** 63, 1 << 10, np.uint64) * np.uint64(2) + np.uint64(1)


def plain(text: bytes | None) -> bytes:
    """The text's words in lower case with blanks between, byte for byte as long as the text."""
    return (text or b"").translate(_PLAIN)


def _chunks(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about ``PIECE`` bytes that end between words."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _hash(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` word numbers from every position of ``at`` on."""
    total = np.zeros(len(at), np.uint64)
    for j in range(size):
        total += (words[at + j].astype(np.uint64) + np.uint64(1)) * _FACTORS[j]
    return total


class Block:
    """Hash set of the windows of some segments: ``segments`` are pairs of an
    item's id (None: not listed) and its words joined by blanks."""

    def __init__(self, segments: list[tuple[str | None, bytes]], window: int):
        self.names = sorted({name for name, _ in segments if name is not None})
        number = {name: i for i, name in enumerate(self.names)}
        self.words: dict[bytes, int] = {}
        coded = [(number.get(name, -1), np.array([self.words.setdefault(w, len(self.words)) for w in text.split()], np.int32))
                 for name, text in segments]
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, words in coded:
            if len(words):
                by_size.setdefault(min(window, len(words)), []).append((item, words))
        self.tables = {size: self._table(some, size) for size, some in by_size.items()}

    @staticmethod
    def _table(segments: list[tuple[int, np.ndarray]], size: int) -> tuple:
        """Distinct windows of one size in order of their hash, the hashes, how many windows share one at most,
        and the items of each window."""
        windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(w, size) for _, w in segments])
        items = np.repeat([i for i, _ in segments], [len(w) - size + 1 for _, w in segments])
        windows, inverse = np.unique(windows, axis=0, return_inverse=True)
        keys = _hash(windows.ravel(), np.arange(len(windows)) * size, size)
        order = keys.argsort(kind="stable")
        windows, keys, place = windows[order], keys[order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        links = np.unique(np.stack([place[inverse.ravel()], items], 1)[items >= 0], axis=0)
        starts = np.searchsorted(links[:, 0], np.arange(len(windows) + 1))
        most = int(np.unique(keys, return_counts=True)[1].max())
        return keys, windows, most, starts, links[:, 1]

    def numbers(self, text: bytes) -> list[np.ndarray]:
        """Numbers of a plain text's words, -1 for a word of no item."""
        return [np.fromiter(map(self.words.get, words := c.split(), repeat(-1)), np.int32, len(words)) for c in _chunks(text)]

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``(size, positions, window, starts, items)`` for each size: where a window of an item occurs."""
        known = np.append(0, (words < 0).cumsum())
        for size, (keys, windows, most, starts, items) in self.tables.items():
            if len(words) < size:
                continue
            at = np.flatnonzero(known[size:] == known[:-size])
            if not len(at):
                continue
            key = _hash(words, at, size)
            low = np.searchsorted(keys, key)
            for k in range(most):               # windows that share a hash
                found = np.minimum(low + k, len(keys) - 1)
                same = (keys[found] == key) & (low + k < len(keys))
                pos, win = at[same], found[same]
                for j in range(size):           # the words themselves
                    agree = words[pos + j] == windows[win, j]
                    pos, win = pos[agree], win[agree]
                if len(pos):
                    yield size, pos, win, starts, items


@lru_cache(maxsize=1)
def _loaded(shared) -> Block:
    """The block of a broadcast.  One is held per worker: a broadcast keeps its
    value once it was read, so the value is taken off it again; its file stays."""
    block = shared.value
    vars(shared).pop("_value", None)
    return block


class Benchmark:
    """The items' windows in broadcast blocks of ``BLOCK_BYTES`` of text at most.

    ``items`` has an id and a text.  A window is ``window`` consecutive words;
    an item of fewer words, but not none, is one window.  Rows that share an id
    are one item with the windows of all; an item without an id marks words
    but is not listed.  A null text has no words.
    """

    def __init__(self, items: DataFrame, *, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW):
        if not 0 < window <= len(_FACTORS):
            raise ValueError(f"window: 1 to {len(_FACTORS)} words")

        def cut(batches):
            for batch in bounded(batches, 1, SLICE):
                names, pieces = [], []
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = plain(text).split()
                    for at in range(0, max(1, len(words) - window + 1), SEGMENT_WORDS):
                        if part := words[at:at + SEGMENT_WORDS + window - 1]:
                            names.append(name)
                            pieces.append(b" ".join(part))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.binary())], ["item", "words"])

        rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t"))
        segments = checkpoint(rows.mapInArrow(cut, "item string, words binary").distinct())
        total = segments.agg(F.sum(F.octet_length("words"))).first()[0] or 0
        n = -(-total // (BLOCK_BYTES // 2))
        while True:
            dealt = segments.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(n, 1))))
            size = F.when(F.count(F.lit(1)) > 1, F.sum(F.octet_length("words")))
            most = dealt.groupBy("block").agg(size.alias("b")).agg(F.max("b")).first()[0] or 0
            if most <= BLOCK_BYTES:         # or one segment alone, which no dealing makes smaller
                break
            n *= 2
        spark = items.sparkSession
        self.blocks = []
        for b in range(n):
            part = [(r["item"], bytes(r["words"])) for r in dealt.where(F.col("block") == b).collect()]
            self.blocks.append(spark.sparkContext.broadcast(Block(part, window)))

    def scan(self, texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray], list[list[str]], list[bytes]]:
        """Per text: number of words, which of them are hit, the ids of the
        items with occurring windows as sorted strings; and the plain texts."""
        texts = [plain(t) for t in texts]
        sizes = [sum(len(c.split()) for c in _chunks(t)) for t in texts] if not self.blocks else None
        covered, found = None, [set() for _ in texts]
        gap = np.full(1, -1, np.int32)
        for shared in self.blocks:
            block = _loaded(shared)
            parts, now = [], []
            for t in texts:
                mine = block.numbers(t)
                now.append(sum(map(len, mine)))
                parts += [*mine, gap]
            words = np.concatenate([gap, *parts])
            if sizes is None:
                sizes, covered = now, np.zeros(len(words), bool)
            begins = np.cumsum([1, *[n + 1 for n in sizes]])
            for size, pos, win, starts, items in block.hits(words):
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, pos, 1)
                np.add.at(change, pos + size, -1)
                covered |= change[:-1].cumsum() > 0
                pairs = np.unique(np.stack([np.searchsorted(begins, pos, "right") - 1, win], 1), axis=0)
                n = starts[pairs[:, 1] + 1] - starts[pairs[:, 1]]
                inner = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
                rows = np.unique(np.stack([np.repeat(pairs[:, 0], n), items[np.repeat(starts[pairs[:, 1]], n) + inner]], 1), axis=0)
                for row, item in rows.tolist():
                    found[row].add(block.names[item])
        hit = [covered[b:b + n] for b, n in zip(np.cumsum([1, *[n + 1 for n in sizes]]), sizes)] if self.blocks else [
            np.zeros(n, bool) for n in sizes]
        return sizes, hit, [sorted(f) for f in found], texts


def spans_of(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of a plain text's runs of hit words, from the first word's start to the last one's end."""
    if not hit.any():
        return []
    inside = np.concatenate([[False], np.frombuffer(text, np.uint8) != 0x20, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(starts[turn[::2]].tolist(), ends[turn[1::2] - 1].tolist()))


def find(docs: DataFrame, benchmark: Benchmark, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_hit, items, spans)`` for every row of ``docs``.

    ``items`` are the ids, as sorted strings, of the benchmark items with a
    window in the text, ``spans`` the byte ranges (UTF-8) of its runs of hit
    words.  A null or empty text has no words; repeated rows give equal rows,
    an empty table or an empty benchmark no hits.  Other columns are not read.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in bounded(batches, 1, SLICE):
            n, hit, items, texts = benchmark.scan(batch.column(1).to_pylist())
            spans = [[{"start": a, "end": b} for a, b in spans_of(t, h)] for t, h in zip(texts, hit)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([int(h.sum()) for h in hit], pa.int64()),
                 pa.array(items, pa.list_(pa.string())), pa.array(spans, span)], ["id", "n_words", "n_hit", "items", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    out = rows.mapInArrow(run, f"id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")
    return out.withColumnRenamed("id", id_col)


def _rewritten(docs: DataFrame, benchmark: Benchmark, text_col: str, keep: Callable[[pa.RecordBatch, list], pa.RecordBatch]) -> DataFrame:
    at = next(i for i, c in enumerate(docs.columns) if c.lower() == text_col.lower())

    def run(batches):
        for batch in bounded(batches, at, SLICE):
            texts = [None if t is None else t.encode() for t in batch.column(at).to_pylist()]
            _, hit, _, plains = benchmark.scan(texts)
            yield keep(batch, [spans_of(t, h) for t, h in zip(plains, hit)])

    return docs.mapInArrow(run, docs.schema)


def drop_documents(docs: DataFrame, benchmark: Benchmark, *, text_col: str = "text") -> DataFrame:
    """``docs`` less the rows with a hit word; the columns are those of ``docs``, whatever their names."""
    return _rewritten(docs, benchmark, text_col, lambda batch, spans: batch.filter(pa.array([not s for s in spans], pa.bool_())))


def drop_spans(docs: DataFrame, benchmark: Benchmark, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every run of hit words cut out of the text; what stands
    around a run stays.  No row goes, a null text stays null."""
    at = next(i for i, c in enumerate(docs.columns) if c.lower() == text_col.lower())

    def keep(batch, spans):
        texts = []
        for text, cut in zip(batch.column(at).to_pylist(), spans):
            if cut:
                raw = text.encode()
                text = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in cut]], [*[s for s, _ in cut], len(raw)])).decode()
            texts.append(text)
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))

    return _rewritten(docs, benchmark, text_col, keep)


# In SQL words are numbered per document and windows compared as joined strings.
_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w FROM documents),
dw AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM d),
h AS (SELECT dw.r, dw.i, bw.m, bw.item_id FROM (SELECT DISTINCT m FROM bw) s
      JOIN dw ON dw.i + s.m - 1 <= len(dw.w) JOIN bw ON bw.m = s.m AND bw.g = array_to_string(dw.w[dw.i:dw.i + s.m - 1], ' ')),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM h) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
       FROM h GROUP BY r)
SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
