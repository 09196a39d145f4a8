"""Shared helpers: document identity, Arrow batches, names that cannot clash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

NULL_ID = 2 ** 63 - 1       # order key of a null id: after every other id
SLICE_BYTES = 8 << 20      # text worked on at once
BROADCAST_ROWS = 50_000     # rows of a few numbers: under 4 MB


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (Spark compares without case)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name = "_" + name
    return name


def id_key(id_col: str) -> Column:
    """Order key of a document: its id as a long, nulls last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def id_of(key: str, kind) -> Column:
    """The id behind an order key."""
    return F.when(F.col(key) != NULL_ID, F.col(key)).cast(kind)


def text_key(text_col: str) -> Column:
    """Second part of a document's identity: a hash of its whole text.

    Rows that share id and text are one document to every operator here and
    get the same result; rows that share only the id stay apart.  Unlike a
    row number, the key survives recomputation on another executor.
    """
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())


def bounded(batches: Iterator[pa.RecordBatch], column: int | str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``size`` bytes of the text
    ``column``, so that what a task holds follows a slice (or one text, if that
    is longer) and not a batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = sizes.astype(np.int64).cumsum() // size
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def text_batches(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[list]]:
    """The named columns of each slice as Python lists; the text comes last."""
    for batch in bounded(batches, columns[-1]):
        yield [batch.column(c).to_pylist() for c in columns]


def small(table: DataFrame) -> DataFrame:
    """A checkpointed table of a few numeric columns, marked for broadcast only
    if it was counted to have at most BROADCAST_ROWS rows; beyond that Spark
    joins it by its key."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table
