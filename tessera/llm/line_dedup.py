"""Line dedup by winnowing over line hashes.

The lines of a document that hold anything but white space are its sequence of
hashes.  Of every window of ``window`` consecutive lines the smallest hash (the
rightmost on a tie) is selected: two equal windows select the same line at the
same offset, so every repeated run of at least ``window`` lines shares a
fingerprint.  Positions are joined to the first position of their fingerprint
and the match is extended line by line both ways over the windows that selected
it.  A window whose match with the first position falls short can still equal
another one; these, and only these, are compared by a hash of the whole window.
Both ways together are exact: a line goes if it lies in a window that equals an
earlier window, in the order (id, position).

Shorter runs count where they are long in words, and a text of fewer lines than
a window is a window as a whole.  Every run of fewer lines is its own
fingerprint, and those that may go are joined to the first position of theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tessera.llm.common import bounded, free_name, id_key, text_batches, text_key
from tessera.session import checkpoint, scratch_path

EDGE = 0        # stands for lines before the first and after the last one
MIX = np.uint64(0x9E3779B97F4A7C15)


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``(index, hash)`` of the \\n-separated lines with a visible character; white space at their ends does not count."""
    lines = (text or "").split("\n")
    index = [i for i, line in enumerate(lines) if line.strip()]
    hashes = [xxhash.xxh3_64_intdigest(lines[i].strip().encode("utf-8", "surrogatepass")) or 1 for i in index]
    return np.array(index, np.int64), np.array(hashes, np.uint64).view(np.int64)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Selected position of every window of ``window`` hashes: the rightmost minimum."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.arange(len(rows)) + window - 1 - rows.argmin(1)


def short_runs(hashes: np.ndarray, words: np.ndarray, window: int, long_words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, ... window - 1 lines the hash of every run of so many lines and
    whether it may go: it has over ``long_words`` words or is the whole text."""
    out = []
    for n in range(1, min(window - 1, len(hashes)) + 1):
        starts = len(hashes) - n + 1
        fp, size = np.zeros(starts, np.uint64), np.zeros(starts, np.int64)
        for k in range(n):
            fp = fp * MIX + hashes[k:k + starts].view(np.uint64)
            size += words[k:k + starts]
        out.append((fp.view(np.int64), (size > long_words) | (n == len(hashes))))
    return out


def fingerprints(docs: DataFrame, window: int, id_col: str, text_col: str, long_words: int | None = None) -> DataFrame:
    """``(fp, d, h, pos, first, last, around)`` per selected line: its hash, the
    document, the position among the document's lines, the starts of the windows
    that selected it, and the hashes of the window - 1 lines on either side.
    ``lines`` is the window; with ``long_words`` there are also the runs of fewer
    ``lines``, with their hash, document, position and ``goes`` (see ``short_runs``)."""
    reach = window - 1

    def run(batches):
        for d, h, texts in text_batches(batches, "d", "h", "t"):
            ids, keys = np.array(d, np.int64), np.array(h, np.int64)
            cols: list[list[np.ndarray]] = [[] for _ in range(6)]
            short: list[list[np.ndarray]] = [[] for _ in range(5)]
            for k, text in enumerate(texts):
                index, hashes = line_hashes(text)
                if long_words is not None and len(hashes):
                    lines = text.split("\n")
                    words = np.array([len(lines[i].split()) for i in index], np.int64)
                    for n, (fp, goes) in enumerate(short_runs(hashes, words, window, long_words), 1):
                        for col, values in zip(short, (fp, np.full(len(fp), k), np.arange(len(fp), dtype=np.int32),
                                                       np.full(len(fp), n, np.int32), goes)):
                            col.append(values)
                picks = winnow(hashes, window)
                if not len(picks):
                    continue
                pos, first, n = np.unique(picks, return_index=True, return_counts=True)
                padded = np.concatenate((np.full(reach, EDGE), hashes, np.full(reach, EDGE)))
                cols[0].append(hashes[pos])
                cols[1].append(np.full(len(pos), k))
                cols[2].append(pos)
                cols[3].append(first)
                cols[4].append(first + n - 1)
                cols[5].append(padded[pos[:, None] + np.arange(2 * reach + 1)])
            if cols[0]:
                fp, row, pos, first, last, around = (np.concatenate(c) for c in cols)
                ends = np.arange(len(fp) + 1, dtype=np.int32) * (2 * reach + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array(ids[row]), pa.array(keys[row]), pa.array(pos.astype(np.int32)),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(around.ravel())),
                     pa.array(np.full(len(fp), window, np.int32)), pa.nulls(len(fp), pa.bool_())],
                    ["fp", "d", "h", "pos", "first", "last", "around", "lines", "goes"])
            if short[0]:
                fp, row, pos, lines, goes = (np.concatenate(c) for c in short)
                none = pa.nulls(len(fp), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp), pa.array(ids[row]), pa.array(keys[row]), pa.array(pos), none, none,
                     pa.nulls(len(fp), pa.list_(pa.int64())), pa.array(lines), pa.array(goes)],
                    ["fp", "d", "h", "pos", "first", "last", "around", "lines", "goes"])

    return docs.select(id_key(id_col).alias("d"), text_key(text_col).alias("h"), F.col(text_col).alias("t")).mapInArrow(
        run, "fp long, d long, h long, pos int, first int, last int, around array<long>, lines int, goes boolean")


def _extent(window: int) -> Column:
    """How many lines around a position equal those around the first one: ``(left, right)``."""
    reach = window - 1

    def run(offsets):
        same = [F.element_at("around", reach + 1 + o) == F.element_at("f.around", reach + 1 + o) for o in offsets]
        out = F.lit(len(offsets))
        for k in range(len(same) - 1, -1, -1):
            out = F.when(same[k], out).otherwise(F.lit(k))
        return out

    return F.struct(run(range(-1, -reach - 1, -1)).alias("left"), run(range(1, reach + 1)).alias("right"))


def repeated_windows(docs: DataFrame, *, window: int, id_col: str = "doc_id", text_col: str = "text",
                     long_words: int | None = None) -> DataFrame:
    """``(d, h, start, lines)``: every window of lines that equals an earlier one,
    and with ``long_words`` every shorter run that does and may go."""
    path = scratch_path(docs.sparkSession, "line-marks")    # the two kinds of rows fill different columns
    fingerprints(docs, window, id_col, text_col, long_words).write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    marks = stored.where(F.col("lines") == window).select("fp", "d", "h", "pos", "first", "last", "around")
    place = F.struct("d", "h", "pos", "around")
    # The first positions are stored, so that both sides of the join are plain
    # exchanges and Spark can split a fingerprint that a third of all lines share.
    firsts = checkpoint(marks.groupBy("fp").agg(F.min(place).alias("f"), F.count("*").alias("n"))
                        .where("n > 1").select("fp", "f"))
    later = (marks.join(firsts, "fp")
             .where("struct(d, h, pos) > struct(f.d, f.h, f.pos)")
             .withColumn("extent", _extent(window))
             .withColumn("start", F.explode(F.sequence("first", "last"))))
    whole = (F.col("pos") - F.col("start") <= F.col("extent.left")) & (
        F.col("start") + F.lit(window - 1) - F.col("pos") <= F.col("extent.right"))
    # windows unlike the first position's: equal windows among them share the hash of all their lines
    lines = F.slice("around", F.col("start") - F.col("pos") + F.lit(window), F.lit(window))
    later = checkpoint(later.select("d", "h", "start", F.when(~whole, F.xxhash64(lines, F.col("fp"))).alias("w")))
    matched = later.where("w is null").select("d", "h", "start")
    rest = later.where("w is not null")
    rest_first = checkpoint(rest.groupBy("w").agg(F.min(F.struct("d", "h", "start")).alias("f"), F.count("*").alias("n"))
                            .where("n > 1").select("w", "f"))
    windows = matched.union(rest.join(rest_first, "w").where("struct(d, h, start) > f").select("d", "h", "start"))
    windows = windows.withColumn("lines", F.lit(window))
    if long_words is None:
        return windows
    short = stored.where(F.col("lines") < window).select("lines", "fp", "d", "h", F.col("pos").alias("start"), "goes")
    short_first = checkpoint(short.groupBy("lines", "fp").agg(
        F.min(F.struct("d", "h", "start")).alias("f"), F.count("*").alias("n"), F.max("goes").alias("any"))
        .where("n > 1 and any").select("lines", "fp", "f"))
    return windows.union(short.where("goes").join(short_first, ["lines", "fp"]).where("struct(d, h, start) > f")
                         .select("d", "h", "start", "lines"))


def drop_repeated_runs(docs: DataFrame, *, window: int = 3, id_col: str = "doc_id", text_col: str = "text",
                       removed_col: str | None = None, long_words: int | None = None) -> DataFrame:
    """``docs`` with ``text_col`` less every run of at least ``window`` lines that occurs earlier.

    With ``long_words`` shorter runs that occur earlier go as well if they have
    more words than that, and so does a text of fewer lines than ``window`` that
    occurs earlier as a whole, there or as a run of a longer text.

    Earlier means in a smaller id (nulls last), in the smaller text hash for
    rows that share an id, or further up in the same document.  Blank lines do
    not count as lines; those inside a removed run go with it.  A text that
    loses all its lines becomes empty, a null text stays null.  Rows that share
    id and text are one document and are changed alike, so the first one's
    lines stay in each.  ``removed_col`` adds the removed line numbers (from 0,
    blank ones included).  An empty table gives an empty table.
    """
    d, h, starts = (free_name(docs, c) for c in ("d", "h", "starts"))
    gone = (repeated_windows(docs, window=window, id_col=id_col, text_col=text_col, long_words=long_words)
            .groupBy(F.col("d").alias(d), F.col("h").alias(h))
            .agg(F.collect_set(F.struct("start", "lines")).alias(starts)))
    keyed = docs.withColumns({d: id_key(id_col), h: text_key(text_col)}).join(gone, [d, h], "left")

    names = docs.columns
    at = names.index(next(c for c in names if c.lower() == text_col.lower()))

    added = [StructField(removed_col, ArrayType(IntegerType()))] if removed_col else []
    schema = StructType(docs.schema.fields + added)

    def cut(batches):
        for batch in bounded(batches, at):
            texts, begun = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            out = [without_lines(t, s) for t, s in zip(texts, begun)]
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array([t for t, _ in out], pa.string())
            if removed_col:
                columns.append(pa.array([r for _, r in out], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names + [c.name for c in added])

    return keyed.select(*[F.col(f"`{c}`") for c in names], starts).mapInArrow(cut, schema)


def without_lines(text: str | None, runs: list[dict] | None) -> tuple[str | None, list[int]]:
    """The text less the ``runs`` (``start`` and number of ``lines``), and the numbers of the removed lines."""
    if not runs or text is None:
        return text, []
    index, _ = line_hashes(text)
    covered = np.zeros(len(index) + 1, int)
    for r in runs:
        covered[r["start"]] += 1
        covered[min(r["start"] + r["lines"], len(index))] -= 1
    dead = covered.cumsum()[:-1] > 0
    lines = text.split("\n")
    drop = np.zeros(len(lines), bool)
    drop[index[dead]] = True
    # blank lines between two neighbouring removed lines
    for a, b in zip(np.flatnonzero(dead)[:-1], np.flatnonzero(dead)[1:]):
        if b == a + 1:
            drop[index[a]:index[b]] = True
    return "\n".join([line for line, gone in zip(lines, drop) if not gone]), np.flatnonzero(drop).tolist()
