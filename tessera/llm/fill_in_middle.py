"""Fill-in-middle: documents cut into prefix, middle and suffix and put in
another order behind markers.

The text of a batch is cut into units (runs of letters, single other
characters) that become one list array over the batch's own bytes.  The lists
are flattened with the index of their parent row; a unit's ordinal against its
row's two cuts gives its role, units are filtered by role, lists rebuilt from
the counts, and each list joined to one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import bounded

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90         # draws of 100 from here on leave the text as it is
SPM_BELOW = 20          # draws of 100 below this put the suffix first
SLICE = 1 << 20         # bytes of text worked on at once

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


def draws(id_col: str, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id``; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.StringArray) -> pa.ListArray:
    """Each text's units, ``[A-Za-z]+|[^A-Za-z]`` from left to right, without a copy of the text."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[:ends[-1]] if data is not None else np.empty(0, np.uint8)
    part = raw[ends[0]:]
    letter = _LETTER[part]
    first = (part & 0xC0) != 0x80                   # not a continuation byte
    first[1:] &= ~(letter[1:] & letter[:-1])
    first[(ends[:-1] - ends[0])[ends[:-1] < ends[1:]]] = True
    starts = (np.flatnonzero(first) + ends[0]).astype(np.int32)
    rows = np.searchsorted(starts, ends[:-1]).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, ends[-1])), pa.py_buffer(raw))
    return pa.ListArray.from_arrays(pa.array(np.append(rows, np.int32(len(starts)))), flat)


def _pieces(lists: pa.ListArray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every row: its units before ``low``, from there to ``high``, and the rest."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    size = pc.list_value_length(lists).to_numpy()
    ordinal = np.arange(len(flat)) - (size.cumsum() - size)[parent]
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    out = []
    for k, n in enumerate((low, high - low, size - high)):
        offsets = pa.array(np.append(0, n.cumsum()).astype(np.int32))
        out.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(flat, pa.array(role == k))), ""))
    return out


def _transformed(texts: pa.StringArray, draw: list[np.ndarray]) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of every text."""
    texts = pc.fill_null(texts, "")
    lists = units(texts)
    n = pc.list_value_length(lists).to_numpy().astype(np.int64)
    cuts = draw[0] % (n + 1), draw[1] % (n + 1)
    prefix, middle, suffix = _pieces(lists, np.minimum(*cuts), np.maximum(*cuts))
    plain = pa.array((n == 0) | (draw[2] % 100 >= PLAIN_FROM))
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, marker))
    spm = pa.array(draw[3] % 100 < SPM_BELOW)
    join = pc.binary_join_element_wise
    output = pc.if_else(plain, texts, pc.if_else(spm, join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, ""),
                                                 join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n), form, *chars, output]


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` for every row of ``docs``.

    ``n`` is the number of units; both cuts and the form follow from the id
    alone, so any executor makes the same document of a row.  A text is left
    ``plain`` if it is empty, holds a marker already, or by its third draw.
    A null text is an empty one, repeated rows give equal rows, an empty table
    an empty one; other columns are not read, so their names cannot clash.
    A batch is worked on by slices of ``SLICE`` bytes (one text, if longer).
    """
    def run(batches):
        for batch in bounded(batches, 1, SLICE):
            draw = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_transformed(batch.column(1), draw)],
                                             ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(id_col, seed))])
    out = rows.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col)


def restore(output: str = "output", form: str = "form") -> Column:
    """The text behind an ``output`` of the given ``form``, exactly: a
    transformed text holds no marker of its own, so the first of each is the
    one that was put there."""
    def cut(rest: Column, marker: str) -> tuple[Column, Column]:
        head = F.substring_index(rest, marker, 1)
        return head, F.substr(rest, F.char_length(head) + F.lit(len(marker) + 1))

    body = F.substr(F.col(output), F.lit(len(PREFIX) + 1))
    prefix, rest = cut(body, SUFFIX)
    suffix, middle = cut(rest, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = cut(body, PREFIX)
    prefix, middle = cut(rest, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
             [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN [0, 1, 2, 3]] AS r FROM d),
c AS (SELECT *, len(u) AS n, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS lo,
             greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS hi FROM u),
p AS (SELECT doc_id, t, n,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
                  WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             coalesce(array_to_string(u[1:lo], ''), '') AS pre,
             coalesce(array_to_string(u[lo + 1:hi], ''), '') AS mid,
             coalesce(array_to_string(u[hi + 1:n], ''), '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS o FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o
              WHEN 'psm' THEN split_part(substr(o, 4), '<S>', 1) || split_part(o, '<M>', 2)
                              || split_part(split_part(o, '<M>', 1), '<S>', 2)
              ELSE split_part(split_part(o, '<M>', 1), '<P>', 2) || split_part(o, '<M>', 2)
                   || split_part(substr(o, 4), '<P>', 1) END) AS restored_sha256
FROM o
"""
