"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text (white space as one space, each byte
shifts the hash by a bit and adds the byte's random number); a chunk ends at a
word whose gear hash is larger than those of its neighbours.  The decision
looks at the ``GEAR_BYTES`` bytes behind each of ``2 * SPREAD + 1`` words, so
an insertion shifts no boundary outside its own neighbourhood and a passage is
cut alike wherever it stands.  Chunks are deduplicated by digest: only the first
occurrence of a digest, in the order (id, position), is original.  A run of
neighbouring repeats with at least ``min_words`` words is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tessera.llm.common import bounded, free_name, id_key, text_batches, text_key
from tessera.session import checkpoint

GEAR_BYTES = 8          # bytes that a gear hash looks back on
SPREAD = 2              # a boundary is the largest among this many words on either side
FORCED_WORDS = 32       # a boundary is set after so many words without one
GEAR = np.random.default_rng(20_240_229).integers(0, 1 << 63, 256, dtype=np.uint64)
_SPACES = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")


def chunks(text: str | None) -> tuple[np.ndarray, ...]:
    """``(start, end, words, digest)`` of the chunks of a whole text: byte
    offsets in its UTF-8 (first word's first byte, last word's end), number of
    words, and a 64-bit digest of the words between single spaces."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    spaced = raw.translate(_SPACES)
    data = np.frombuffer(spaced, np.uint8)
    blank = data == 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    starts, ends = edge[0::2], edge[1::2]
    n = len(starts)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, none
    tight = np.flatnonzero(~blank | np.concatenate(([True], ~blank[:-1])))     # single spaces only
    packed = data[tight] if len(tight) < len(data) else data
    shift = np.searchsorted(tight, ends - 1) if len(tight) < len(data) else ends - 1
    gear = GEAR[packed]
    width = 1
    while width < GEAR_BYTES:
        gear[width:] += gear[:-width] << np.uint64(width)
        width *= 2
    value = gear[shift] >> np.uint64(4)
    cut = np.ones(n, bool)
    for k in range(1, SPREAD + 1):
        cut[k:] &= value[k:] > value[:-k]
        cut[:-k] &= value[:-k] >= value[k:]
    # the ends of a text look on fewer neighbours: they settle nothing, the last word ends a chunk
    cut[:SPREAD] = False
    cut[n - SPREAD:] = False
    cut[n - 1] = True
    stop = np.flatnonzero(cut)
    begin = np.concatenate(([0], stop[:-1] + 1))
    if (stop - begin).max() >= FORCED_WORDS:
        stop = np.concatenate([np.append(np.arange(b + FORCED_WORDS - 1, s, FORCED_WORDS), s)
                               for b, s in zip(begin.tolist(), stop.tolist())])
        begin = np.concatenate(([0], stop[:-1] + 1))
    left, right = starts[begin], ends[stop]
    digest = xxhash.xxh3_64_intdigest
    if len(tight) == len(data):
        parts = [digest(spaced[a:b]) for a, b in zip(left.tolist(), right.tolist())]
    else:
        parts = [digest(b" ".join(spaced[a:b].split())) for a, b in zip(left.tolist(), right.tolist())]
    return left, right, stop - begin + 1, np.array(parts, np.uint64).view(np.int64)


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(digest, d, h, at)`` per chunk: ``at`` is its number in the document."""
    def run(batches):
        for d, h, texts in text_batches(batches, "d", "h", "t"):
            found = [chunks(t)[3] for t in texts]
            sizes = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found) if found else np.empty(0, np.int64)),
                 pa.array(np.repeat(np.array(d, np.int64), sizes)), pa.array(np.repeat(np.array(h, np.int64), sizes)),
                 pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes] or [np.empty(0, np.int32)]))],
                ["digest", "d", "h", "at"])

    return docs.select(id_key(id_col).alias("d"), text_key(text_col).alias("h"), F.col(text_col).alias("t")).mapInArrow(
        run, "digest long, d long, h long, at int")


def repeated_chunks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(d, h, at)`` of every chunk whose digest occurs at an earlier place.
    Rows that share id and text are one document."""
    table = chunk_table(docs, id_col, text_col)
    place = F.struct("d", "h", "at")
    # Repeated digests are counted first (a number per digest and task is shuffled),
    # and places are compared only among these.  Both tables are stored, so that
    # either join is between plain exchanges and Spark can split a digest that a
    # third of all documents share.
    repeated = checkpoint(table.groupBy("digest").count().where("count > 1").select("digest"))
    hits = checkpoint(table.join(repeated, "digest"))
    firsts = checkpoint(hits.groupBy("digest").agg(F.min(place).alias("low")))
    return hits.join(firsts, "digest").where("struct(d, h, at) > low").select("d", "h", "at")


def drop_repeated_passages(docs: DataFrame, *, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
                           spans_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` less every run of repeated chunks of at least
    ``min_words`` words.

    Order and identity are those of line dedup: smaller ids first (nulls last),
    rows that share id and text are one document and change alike.  What
    remains on both sides of a removed run keeps one separator: the white space
    in front of the run, and none where the run began the text.  A text that is
    removed as a whole becomes empty, a null text stays null.  ``spans_col``
    adds the removed ``(start, end)`` byte ranges of the UTF-8 text.  An empty
    table gives an empty table.
    """
    d, h, hits = (free_name(docs, c) for c in ("d", "h", "hits"))
    gone = (repeated_chunks(docs, id_col=id_col, text_col=text_col)
            .groupBy(F.col("d").alias(d), F.col("h").alias(h)).agg(F.collect_set("at").alias(hits)))
    keyed = docs.withColumns({d: id_key(id_col), h: text_key(text_col)}).join(gone, [d, h], "left")
    names = docs.columns
    at = names.index(next(c for c in names if c.lower() == text_col.lower()))

    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    added = [StructField(spans_col, ArrayType(span))] if spans_col else []
    schema = StructType(docs.schema.fields + added)

    def cut(batches):
        for batch in bounded(batches, at):
            texts, found = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            out = [without_chunks(t, f, min_words) for t, f in zip(texts, found)]
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array([t for t, _ in out], pa.string())
            if spans_col:
                columns.append(pa.array([[{"start": a, "end": b} for a, b in s] for _, s in out],
                                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            yield pa.RecordBatch.from_arrays(columns, names + [c.name for c in added])

    return keyed.select(*[F.col(f"`{c}`") for c in names], hits).mapInArrow(cut, schema)


def without_chunks(text: str | None, hits: list[int] | None, min_words: int) -> tuple[str | None, list[tuple[int, int]]]:
    """The text less its runs of chunks ``hits`` with enough words, and the byte ranges removed."""
    if not hits or text is None:
        return text, []
    start, end, words, _ = chunks(text)
    at = np.unique(np.array(hits))
    breaks = np.flatnonzero(np.diff(at) > 1) + 1
    spans = [(int(start[run[0]]), int(end[run[-1]])) for run in np.split(at, breaks) if words[run].sum() >= min_words]
    if not spans:
        return text, []
    raw = text.encode("utf-8", "surrogatepass")
    keep, done = [], 0
    for a, b in spans:
        keep.append(raw[done:a])
        done = b
        if not b"".join(keep).strip():
            keep, done = [], b + len(raw[b:]) - len(raw[b:].lstrip())
        elif keep[-1][-1:].isspace():       # one separator: the one in front
            done = b + len(raw[b:]) - len(raw[b:].lstrip())
    keep.append(raw[done:])
    out = b"".join(keep).decode("utf-8", "surrogatepass")
    return (out if raw[done:].strip() else out.rstrip()), spans
