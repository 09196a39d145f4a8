"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent 1- to 3-grams of letters, words
padded with a blank.  A document's profile is compared to each language's by
the out-of-place distance: how many ranks every gram of the document is away
from its place in the language's profile, ``SIZE`` if it has none there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.llm.common import bounded
from tessera.session import checkpoint

SIZE = 300              # grams in a profile
MAX_LANGUAGES = 1000    # distinct values of the language column; profiles of so many are 5 MB
LONGEST = 3             # letters in a gram at most
FLUSH = 1_000_000       # distinct grams a task holds before it hands them on
PIECE = 1 << 17         # characters counted at once
SLICE = 1 << 20         # bytes of text worked on at once

_BITS = 21              # a code point; a gram of up to three fits in a long
_MASK = (1 << _BITS) - 1


def _letter_table() -> np.ndarray:
    """Each code point's letter in lower case, 0 for what is not a letter."""
    table = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_LETTERS: np.ndarray | None = None


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, every run of other characters
    as one 0, a 0 at both ends; empty if there is no letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letter_table()
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    mapped = np.zeros(len(codes) + 2, np.int32)
    mapped[1:-1] = _LETTERS[codes]
    keep = mapped != 0
    keep[1:] |= mapped[:-1] != 0          # the first blank behind a letter
    keep[0] = True
    mapped = mapped[keep]
    return mapped if len(mapped) > 1 else np.empty(0, np.int32)


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams (packed into longs) of a letter sequence and their counts.
    Grams of more than a letter may begin or end with the blank between words."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(codes), PIECE):
        part = codes[at:at + PIECE + LONGEST - 1].astype(np.int64)
        head = min(PIECE, len(codes) - at)
        grams = [part[:head][part[:head] > 0]]
        for n in range(2, LONGEST + 1):
            m = min(head, len(part) - n + 1)
            if m <= 0:
                break
            packed, inner = part[:m].copy(), np.ones(m, bool)
            for k in range(1, n):
                packed = packed << _BITS | part[k:k + m]
                if k < n - 1:
                    inner &= part[k:k + m] > 0
            first, last = part[:m] > 0, part[n - 1:n - 1 + m] > 0
            grams.append((packed | (n << 2 * _BITS if n == 2 else 0))[inner & (first | last)])
        found = np.unique(np.concatenate(grams), return_counts=True)
        keys, counts = _merged([keys, found[0]], [counts, found[1]]) if len(keys) else found
    return keys, counts


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)


def top_grams(keys: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Grams by falling count, equal counts by the gram."""
    return keys[np.lexsort((keys, -counts))[:size]]


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is left out of the training: CRC-32 of its id as text is 0 modulo ``folds``.
    A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train_profiles(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", size: int = SIZE) -> DataFrame:
    """``(lang, gram, rank)``: the ``size`` most frequent grams of each language
    over all the rows given (null languages or texts teach nothing).

    Tasks count in vectors and hand on partial counts, which Spark adds up.
    """
    def run(batches):
        held: dict[str, tuple[list, list]] = {}
        n = 0

        def flush():
            for lang, (keys, counts) in held.items():
                k, c = _merged(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(c)],
                                                 ["lang", "gram", "n"])

        for batch in bounded(batches, 0, SLICE):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(texts, langs):
                by.setdefault(lang, []).append(letters(text))
            for lang, parts in by.items():
                keys, counts = gram_counts(np.concatenate(parts))
                into = held.setdefault(lang, ([], []))
                into[0].append(keys)
                into[1].append(counts)
                n += len(keys)
            if n > FLUSH:
                yield from flush()
                held, n = {}, 0
        yield from flush()

    rows = docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(
        "t is not null and l is not null")
    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).select(
        "lang", "gram", (F.col("rank") - 1).alias("rank"))


class Profiles:
    """Language profiles on the driver, broadcast: ``size`` grams for each
    distinct value of the language column (a few KB a language).  A column of
    more than ``MAX_LANGUAGES`` values is an error: it holds something else."""

    def __init__(self, table: DataFrame, size: int = SIZE):
        table = checkpoint(table)
        if (n := table.select("lang").distinct().count()) > MAX_LANGUAGES:
            raise ValueError(f"{n} languages")
        found: dict[str, dict[int, int]] = {}
        for r in table.collect():
            found.setdefault(r["lang"], {})[r["gram"]] = r["rank"]
        langs = sorted(found)
        grams = np.unique(np.array([g for p in found.values() for g in p], np.int64))
        ranks = np.full((len(langs), len(grams) + 1), size, np.int64)       # last column: not in any profile
        for i, lang in enumerate(langs):
            at = np.searchsorted(grams, np.array([*found[lang]], np.int64))
            ranks[i, at] = [*found[lang].values()]
        self._shared = table.sparkSession.sparkContext.broadcast((langs, grams, ranks, size))

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and score of a text; see ``identify``."""
        langs, grams, ranks, size = self._shared.value
        codes = letters(text)
        if not len(codes) or not langs:
            return "und", 0.0
        own = top_grams(*gram_counts(codes), size)
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        at = np.where(grams[at] == own, at, len(grams))
        known = ranks[:, at]
        places = np.where(known < size, np.abs(known - np.arange(len(own))), size)
        far = places.sum(1)
        best = int(far.argmin())
        return langs[best], 1.0 - float(far[best]) / (size * len(own))


def score_limits(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", lang_col: str = "lang", share: float = 0.001,
                 margin: float = 0.7) -> dict[str, float]:
    """For each language the score under which a text is taken to be in none:
    ``margin`` times the score that all but ``share`` of the documents reach that
    are labelled with the language and predicted as such.  Every labelled
    document is scored; a language that none is predicted as has no limit."""
    scored = identify(docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where("l is not null"),
                      profiles, text_col="t", lang_name="p", score_name="s").where("l = p")
    low = scored.groupBy("p").agg(F.percentile_approx("s", share, 10_000).alias("s"))
    return {r["p"]: margin * r["s"] for r in low.collect()}


def identify(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", lang_name: str = "lang_pred",
             score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 (no gram in
    place) to 1 (the document's profile is the language's).

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned.  Equal distances go to the smaller language name.  Only the
    text decides; repeated rows get equal results.  The two names must be free.
    """
    if taken := {lang_name.lower(), score_name.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns in use: {sorted(taken)}")
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == text_col.lower())

    def run(batches):
        for batch in bounded(batches, at, SLICE):
            found = [profiles.classify(t) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array([x for x, _ in found], pa.string()),
                       pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, lang_name, score_name])

    added = [StructField(lang_name, StringType()), StructField(score_name, DoubleType())]
    return docs.mapInArrow(run, StructType(docs.schema.fields + added))
