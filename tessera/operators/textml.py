"""spark.ml text pipelines: whitespace tokens, stop words, count vectors,
smoothed IDF, chi-squared feature selection, linear classifiers.

The feature stages are fitted once and their output cached; every
classifier is fitted on top of that table (instead of re-fitting the
tokenizer / vectorizer / IDF inside each model's pipeline).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel, StopWordsRemover, Tokenizer,
                                VectorSlicer)
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import unwrap_udt

from tessera.functions.distributions import chi2_log_tail

MAX_LABELS = 100        # classes of the chi-squared test: a column of counts each


def feature_stages(text_col: str = "text", vocab_size: int = 5000, min_df: float = 10,
                   max_df: float = 5000):
    tok = Tokenizer(inputCol=text_col, outputCol="words")
    rem = StopWordsRemover(inputCol="words", outputCol="filtered")
    cv = CountVectorizer(inputCol="filtered", outputCol="counts", vocabSize=vocab_size,
                         minDF=min_df, maxDF=max_df)
    idf = IDF(inputCol="counts", outputCol="features")
    return [tok, rem, cv, idf]


def term_stats(filtered: DataFrame, tokens_col: str = "filtered") -> DataFrame:
    """(term, n, df): total count and number of documents per term, from one
    pass: a document's distinct terms with their counts come from its own row."""
    def marked(s):          # sorted tokens, the first of each run marked
        return F.transform(s, lambda w, i: F.struct(w.alias("term"), (~F.get(s, i - 1).eqNullSafe(w)).cast("int").alias("new")))

    # the sorted array is a lambda's variable: made once a document, and no exploded row carries it
    runs = F.element_at(F.transform(F.array(F.sort_array(tokens_col)), marked), 1)
    rows = filtered.select(F.explode(runs).alias("r")).select("r.term", "r.new")
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("new").alias("df"))


def vocabulary_frame(filtered: DataFrame, tokens_col: str = "filtered", vocab_size: int = 5000,
                     min_df: float = 10, max_df: float = 5000) -> DataFrame:
    """CountVectorizer's vocabulary rule as a DataFrame (idx, term, n, df):
    terms in at least ``min_df`` and at most ``max_df`` documents (fractions
    of the corpus when < 1), the ``vocab_size`` most frequent, ties broken by
    term so the set and the positions are the same on every run.  The
    ranking window runs over the ``vocab_size`` rows kept by the top-k."""
    stats = term_stats(filtered, tokens_col)
    if min_df < 1 or max_df < 1:
        n_docs = filtered.count()
        min_df = min_df * n_docs if min_df < 1 else min_df
        max_df = max_df * n_docs if max_df < 1 else max_df
    keep = stats.where((F.col("df") >= F.lit(float(min_df))) & (F.col("df") <= F.lit(float(max_df))))
    top = keep.orderBy(F.desc("n"), F.asc("term")).limit(int(vocab_size))
    pos = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("term"))) - 1
    return top.select(pos.alias("idx"), "term", "n", "df")


def count_vocabulary(filtered: DataFrame, tokens_col: str = "filtered", vocab_size: int = 5000,
                     min_df: float = 10, max_df: float = 5000) -> list[str]:
    """The vocabulary terms in position order (at most ``vocab_size`` reach the driver)."""
    v = vocabulary_frame(filtered, tokens_col, vocab_size, min_df, max_df)
    return [r.term for r in v.orderBy("idx").collect()]


def filtered_tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Tokenizer + StopWordsRemover output (column ``filtered``)."""
    tok, rem = feature_stages(text_col)[:2]
    return rem.transform(tok.transform(df))


def fit_text_features(train: DataFrame, text_col: str = "text", vocab_size: int = 5000,
                      min_df: float = 10, max_df: float = 5000) -> PipelineModel:
    """Tokenizer -> StopWordsRemover -> count vectors -> IDF, fitted once.
    The count-vector stage is a CountVectorizerModel built from
    ``count_vocabulary`` (CountVectorizer.fit orders equal counts
    arbitrarily, which changes the selected set when the vocabulary is cut)."""
    tok, rem, _, idf = feature_stages(text_col, vocab_size, min_df, max_df)
    filtered = rem.transform(tok.transform(train))
    vocab = count_vocabulary(filtered, "filtered", vocab_size, min_df, max_df)
    cvm = CountVectorizerModel.from_vocabulary(vocab, inputCol="filtered", outputCol="counts")
    idf_model = idf.fit(cvm.transform(filtered))
    return PipelineModel(stages=[tok, rem, cvm, idf_model])


def token_counts(df: DataFrame, text_col: str = "text", remove_stop_words: bool = False) -> DataFrame:
    """(token, n) over the corpus after ``Tokenizer`` (and optionally ``StopWordsRemover``)."""
    out = Tokenizer(inputCol=text_col, outputCol="words").transform(df.select(text_col))
    col = "words"
    if remove_stop_words:
        out = StopWordsRemover(inputCol="words", outputCol="filtered").transform(out)
        col = "filtered"
    return out.select(F.explode(col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_table(model: PipelineModel, spark) -> DataFrame:
    """(idx, term) of the fitted CountVectorizer (at most vocabSize rows)."""
    vocab = model.stages[2].vocabulary
    return spark.createDataFrame(list(enumerate(vocab)), "idx int, term string")


def idf_table(model: PipelineModel, spark) -> DataFrame:
    """(idx, term, idf) of the fitted IDF stage; idf = ln((m + 1) / (df + 1))."""
    vocab = model.stages[2].vocabulary
    weights = model.stages[3].idf.toArray().tolist()
    return spark.createDataFrame([(i, t, float(w)) for i, (t, w) in enumerate(zip(vocab, weights))],
                                 "idx int, term string, idf double")


def feature_cells(features: DataFrame, features_col: str, *keep: str) -> DataFrame:
    """(keep.., idx, value): the cells of every vector that are not 0."""
    v = unwrap_udt(F.col(features_col))
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.transform(v["values"], lambda x, i: i))
    cells = features.select(*keep, F.explode(F.arrays_zip(at.alias("idx"), v["values"].alias("value"))).alias("c"))
    return cells.select(*keep, "c.idx", "c.value").where("value <> 0")


def chi2_table(features: DataFrame, vocab: DataFrame, features_col: str = "features",
               label_col: str = "label", binarize: bool = False) -> DataFrame:
    """Pearson chi-squared independence test of every feature against the
    label, each distinct value being a category, however many there are:
    (idx, term, statistic, dof, p_value, log_p) for each term of ``vocab``.

    The contingency table is kept sparse.  One aggregate counts the rows of
    each (feature, value) by label, over the cells that are not 0; a second adds
    up the features.  The cell of the value 0 is what is left of the labels'
    totals.  ``binarize`` takes presence / absence of the term as the value.

    Rows without a label or vector are left out.  A feature with one value has
    statistic 0, 0 degrees of freedom and p 1.  A tail below the smallest
    double has p 0 and its logarithm in ``log_p``.
    """
    rows = features.where(F.col(label_col).isNotNull() & F.col(features_col).isNotNull())
    totals = sorted((r[0], r[1]) for r in rows.groupBy(label_col).count().limit(MAX_LABELS + 1).collect())
    if len(totals) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    n = float(sum(c for _, c in totals)) or 1.0

    def part(observed: list[Column]) -> Column:         # one value's share of the statistic
        total = sum(observed, F.lit(0.0))
        return sum(((o - total * (c / n)) * (o - total * (c / n)) / (total * (c / n)) for o, (_, c) in zip(observed, totals)), F.lit(0.0))

    names = [f"o{i}" for i in range(len(totals))]
    value = F.lit(1.0) if binarize else F.col("value")
    cells = feature_cells(rows, features_col, label_col).groupBy("idx", value.alias("value")).agg(
        *[F.count(F.when(F.col(label_col) == label, 1)).cast("double").alias(o) for o, (label, _) in zip(names, totals)])
    sums = cells.select("idx", part([F.col(o) for o in names]).alias("part"), *names).groupBy("idx").agg(
        F.sum("part").alias("part"), F.count(F.lit(1)).alias("values"), *[F.sum(o).alias(o) for o in names])
    zero = [c - F.col(o) for o, (_, c) in zip(names, totals)]
    left = sum(zero, F.lit(0.0))
    test = sums.select("idx", (F.col("values") + (left > 0).cast("int") - 1).alias("categories"),
                       (F.col("part") + F.when(left > 0, part(zero)).otherwise(0.0)).alias("statistic"))
    dof = F.coalesce(F.col("categories"), F.lit(0)) * max(len(totals) - 1, 0)
    out = vocab.select("idx", "term").join(test, "idx", "left").select(
        "idx", "term", F.when(dof > 0, F.col("statistic")).otherwise(0.0).alias("statistic"), dof.alias("dof"))
    tail = chi2_log_tail(F.col("statistic"), F.col("dof"))
    return out.withColumn("log_p", tail).select("idx", "term", "statistic", "dof", F.exp("log_p").alias("p_value"), "log_p")


def top_features(chi2: DataFrame, n: int = 200) -> DataFrame:
    """(rank, idx, term, statistic, dof) of the ``n`` terms with the smallest
    p-values of ``chi2_table``, by their logarithm to eight places; equal ones go by position."""
    rows = chi2.withColumn("log_p", F.round("log_p", 8))
    top = rows.orderBy("log_p", "idx").limit(n)
    return top.select(F.row_number().over(Window.orderBy("log_p", "idx")).alias("rank"), "idx", "term", "statistic", "dof")


def slicer(indices: list[int], features_col: str = "features", out: str = "chosen") -> VectorSlicer:
    return VectorSlicer(inputCol=features_col, outputCol=out, indices=sorted(indices))


def logistic(features_col: str = "features", label_col: str = "label", max_iter: int = 20) -> LogisticRegression:
    return LogisticRegression(labelCol=label_col, featuresCol=features_col, maxIter=max_iter)


def linear_svc(features_col: str = "features", label_col: str = "label", max_iter: int = 20) -> LinearSVC:
    return LinearSVC(labelCol=label_col, featuresCol=features_col, maxIter=max_iter)
