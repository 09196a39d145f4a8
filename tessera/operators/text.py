"""Corpus parsing, tokenizing, vocabulary and TF-IDF tables.

Vectors are kept as long sparse tables ``(doc_id, idx, value)`` instead of
dense vocabulary-wide arrays: only non-zero cells exist, and every step is a
join or an aggregate that Spark partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.functions.columns import markup_id, markup_is_valid, markup_text, tokenize_letters


def parse_docs(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Corpus lines -> (doc_id string, text); lines without the markers are dropped."""
    return (lines.where(markup_is_valid(value_col))
            .select(markup_id(value_col).alias("doc_id"), markup_text(value_col).alias("text")))


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words array) with the letters-only tokenizer."""
    return docs.select(F.col(id_col).alias("doc_id"), tokenize_letters(text_col).alias("words"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens per document (0 for a document without letters)."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.size(tokenize_letters(text_col)).cast("long").alias("n_tokens"))


def doc_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per token occurrence: (doc_id, word).

    ``explode_outer`` on purpose: for ``explode`` Catalyst infers a
    ``size(words) > 0`` filter that evaluates the whole tokenizer a second
    and third time; the null word of an empty document is dropped by the
    inner vocabulary join that always follows."""
    return tokens(docs, id_col, text_col).select("doc_id", F.explode_outer("words").alias("word"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over the whole corpus; partial counts combine in each task.
    Built on the same ``doc_words`` subtree as ``doc_terms`` so a job that
    needs both shares the scan (and any exchange below it)."""
    return (doc_words(docs, id_col, text_col).where(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def vocabulary(counts: DataFrame, size: int, word_col: str = "word", count_col: str = "n") -> DataFrame:
    """The ``size`` most frequent words with dense positions 0..size-1
    (frequency descending, word ascending on ties).

    ``orderBy().limit()`` runs as TakeOrderedAndProject; the position is
    numbered over those ``size`` rows only, so the one-partition window is
    bounded by ``size``, not by the corpus.
    """
    top = counts.orderBy(F.desc(count_col), F.asc(word_col)).limit(size)
    w = Window.orderBy(F.desc(count_col), F.asc(word_col))
    return top.select(F.col(word_col).alias("word"), F.col(count_col).alias("n"),
                      (F.row_number().over(w) - 1).alias("idx"))


def word_lookup(words: DataFrame, vocab: DataFrame, word_col: str = "word") -> DataFrame:
    """Position of each given word; null when the word is not in the vocabulary."""
    v = vocab.select(F.col("word").alias(word_col), "idx")
    return words.join(F.broadcast(v), word_col, "left")


def doc_terms(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              totals: bool = False) -> DataFrame:
    """(doc_id, idx, n): in-vocabulary word counts per document; with ``totals``
    also ``total``, the document's in-vocabulary words, on each of its rows.

    The vocabulary has at most ``size`` rows, so it is broadcast: the token
    stream is never shuffled by word (frequent words would skew that shuffle).
    """
    v = F.broadcast(vocab.select("word", "idx"))
    # A document's indices are gathered first (bounded by the document) and
    # counted inside its row, as runs of the sorted array: a partition of them
    # packs well, so what a task would hold to group or sort its cells is many
    # times the bytes by which Spark sizes partitions.
    by_doc = (doc_words(docs, id_col, text_col).join(v, "word")
              .groupBy("doc_id").agg(F.collect_list("idx").alias("all"))
              .select("doc_id", F.sort_array("all").alias("all"), F.size("all").alias("total")))
    at = F.sequence(F.lit(0), F.col("total") - 1)
    starts = F.filter(at, lambda i: (i == 0) | (F.get("all", i) != F.get("all", i - 1)))
    runs = by_doc.select("*", starts.alias("starts"))
    cells = F.transform("starts", lambda s, i: F.struct(
        F.get("all", s).alias("idx"), (F.coalesce(F.get("starts", i + 1), F.col("total")) - s).cast("long").alias("n")))
    terms = runs.select("doc_id", "total", F.explode(cells).alias("cell"))
    return terms.select("doc_id", "cell.idx", "cell.n", *[F.col("total").cast("long").alias("total")] * totals)


def term_freq(terms: DataFrame) -> DataFrame:
    """(doc_id, idx, tf) with tf = n / in-vocabulary tokens of the document.
    Documents without in-vocabulary words have no rows.  Without the column
    ``total`` of ``doc_terms`` a window sorts the terms by document for it."""
    total = F.col("total") if "total" in terms.columns else F.sum("n").over(Window.partitionBy("doc_id"))
    return terms.select("doc_id", "idx", (F.col("n") / total).alias("tf"))


def doc_freq(terms: DataFrame) -> DataFrame:
    """(idx, df): number of documents containing each vocabulary word."""
    return terms.groupBy("idx").agg(F.count(F.lit(1)).alias("df"))


def idf(freq: DataFrame, n_docs: Column | int) -> DataFrame:
    """(idx, idf) with idf = ln(N / (df + 1)); may be <= 0 for very common words."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return freq.select("idx", F.ln(n.cast("double") / (F.col("df") + F.lit(1))).alias("idf"))


def tfidf(tf: DataFrame, idf_df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, idx, weight = tf * idf); the idf table is vocabulary-sized and broadcast."""
    return tf.join(F.broadcast(idf_df), "idx").select(key, "idx", (F.col("tf") * F.col("idf")).alias("weight"))


def line_count(df: DataFrame) -> Column:
    """Row count as a scalar-subquery column (no driver round trip)."""
    return df.select(F.count(F.lit(1))).scalar()
