"""Host-level quality rules, with DataFrame functions only.

Every document is measured and checked against its own rules; the failures
are added up per host, each host's failure rate is shrunk towards an empirical
beta prior fitted to all hosts, and the host's verdict is joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tessera.session import checkpoint

MIN_WORDS = 50              # fewer words fail
MAX_REPEAT_PERCENT = 50     # more words in repeated 3-word windows fail
MAX_HOST_RATE = 0.5         # a host whose shrunk failure rate is above loses its documents
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"


def _stripped_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use``
    and the functions inside it refer to it."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window which the text holds twice or more.

    The windows are hashed; only where two hashes agree are the windows sorted
    to find the repeated ones, whose words are then counted from their sorted
    positions.
    """
    def marked(placed: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(x["h"] == F.get(placed, k)["h"], F.lit(False))
        return F.transform(placed, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = F.array_sort(F.filter(_let(placed, marked), lambda i: i.isNotNull()))
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")), lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["at"])).alias("n"), i.alias("at")), lambda acc: acc["n"])

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                         lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 4, 0).otherwise(_let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def measure(docs: DataFrame, *, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` columns and the measures of every whole text (null: no words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(*keep, text.alias("_text"))
    by_word = _let(_stripped_words(F.col("_text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    repeated = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return base.select(
        *[F.col(c) for c in base.columns if c != "_text"], by_word.alias("_w"),
        F.char_length(F.translate("_text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated.cast("long").alias("n_dup_lines")).select("*", "_w.*").drop("_w")


def host_rates(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """``(host, n_docs, n_failed, shrunk_rate)`` per value of ``host``.

    The beta prior comes from the hosts' own rates by the method of moments:
    mean m and variance v over the hosts give a strength s = m (1 - m) / v - 1
    (at least 0; hosts all alike, or one host: prior strength ``1``), and a
    host's rate becomes (failures + s m) / (documents + s).
    """
    hosts = judged.groupBy(host).agg(F.count("*").alias("n_docs"),
                                     F.sum(F.col(failed).cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("_m"), F.var_pop(rate).alias("_v")).select(
        "_m", F.when(F.col("_v") > 0, F.greatest(F.col("_m") * (1 - F.col("_m")) / F.col("_v") - 1, F.lit(0.0)))
        .otherwise(1.0).alias("_s"))
    return hosts.join(F.broadcast(prior)).withColumn(       # one row
        "shrunk_rate", (F.col("n_failed") + F.col("_s") * F.col("_m")) / (F.col("n_docs") + F.col("_s"))).drop(
        "_m", "_s")


def host_verdicts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: its measures, ``base_failed``, the host's shrunk
    failure rate and ``kept``.

    A document is kept if it passes its own rules and its host's shrunk failure
    rate is at most ``max_host_rate``.  A null text has no words and fails; a
    null host is a host of its own.  Repeated rows are judged each and count
    each; an empty table gives an empty table; other columns are not read.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    measured = measure(docs, text_col=text_col, keep=[F.col(id_col).alias("_id"), F.col(host_col).alias("_host")])
    judged = checkpoint(measured.withColumn("base_failed", failed))
    # stored, so that Spark knows its size: broadcast if small, else a join of plain exchanges that splits a hot host
    hosts = checkpoint(host_rates(judged, "_host", "base_failed").select(F.col("_host").alias("_h"), "shrunk_rate"))
    out = judged.join(hosts, F.col("_host").eqNullSafe(F.col("_h")))
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.round("shrunk_rate", 9).alias("host_rate"),
                      (~F.col("base_failed") & (F.col("shrunk_rate") <= max_host_rate)).alias("kept"))


# The same rows as DuckDB SQL over the table ``documents``.
ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM w),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS f FROM j GROUP BY source),
p AS (SELECT avg(f / n) AS mean, var_pop(f / n) AS v FROM h),
s AS (SELECT mean, CASE WHEN v > 0 THEN greatest(mean * (1 - mean) / v - 1, 0) ELSE 1 END AS strength FROM p),
k AS (SELECT source, (f + strength * mean) / (n + strength) AS rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(rate, 9) AS host_rate, NOT base_failed AND rate <= 0.5 AS kept
FROM j JOIN k ON j.source IS NOT DISTINCT FROM k.source
"""
