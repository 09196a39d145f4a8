"""Each public function here is one registered query: ``(spark, sf_dir) -> DataFrame``.

The reference's own inputs (taxi trips, a wiki corpus, category links,
airports) are not available, so every operator runs on an analogue built
from the driver tables:

* trips      <- lineitem  (supplier = vehicle, part = driver, quantity*60 =
                 seconds, quantity = distance, extendedprice = fare,
                 tax = tolls, extendedprice*(1-discount)*(1+tax) = total)
* corpus     <- documents (doc_id, text); raw corpus lines are rendered as
                 ``<doc id=".." url="..">text</doc>`` and parsed back
* category links <- documents (one link to ``lang``, one to ``source``);
                 page/category statistics use lineitem (order -> part)
* query texts <- benchmark;  binary labels <- labels.quality (and
                 labels.toxic as a given prediction for metric checks)
* airports   <- part (size, retail price, brand number; label from p_type)
                 and embeddings (64-d vectors, ``label`` as the cluster)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tessera.functions.columns import prefix_label
from tessera.operators import (classify, cleaning, clustering, fitcheck, linear, logistic, metrics, textml,
                               ranking, retrieval, text)
from tessera.session import checkpoint, dealt, input_path, load, spread
from tessera.sources import files

# Fixed parameters of the reference workloads.
TOP_K = 10                      # top-10 lists and k nearest neighbours
VOCAB_RETRIEVAL = 20000         # dictionary size of the TF-IDF / kNN job
VOCAB_LOGREG = 10000            # dictionary size of the logistic-regression job
GD_RATE, GD_STEPS_LINE, GD_STEPS_MULTI = 1e-4, 80, 70
LR_STEPS, LR_RATE, LR_REG = 20, 0.01, 0.01
LR_START_STD, LR_SEED, LR_COMPARE_STEPS, LR_BATCH = 0.1, 0, 5, 100
ML_MIN_DF, ML_MAX_SHARE, ML_SELECTED = 10, 0.9, 200
LR_COMPARED = ("Momentum", "Nesterov", "Adam", "Adagrad", "RMSprop")
# The dictionary probe words.
PROBE_WORDS = ["applicant", "and", "attack", "protein", "car", "in"]
# Analogue thresholds: fare bounds scaled to the extendedprice range.
FARE_LOW, FARE_HIGH = 1000.0, 60000.0
# Analogue label map over p_type (four mapped values, the rest unmatched).
SITE_LABELS = {"SMALL": 1, "MEDIUM": 2, "LARGE": 3, "STANDARD": 4}
SOURCE_PREFIX = "src1"
LINE_SEP = "\u001e"             # record separator: corpus texts contain newlines
KMEANS_K, CLUSTER_TOL, CLUSTER_SEED, LLOYD_STEPS = 3, 1e-4, 10, 8
MIXTURE_STEPS, SWEEP_KS = 8, range(2, 10)
SCI = "%.9e"


# --------------------------------------------------------------------------- inputs

def trips(spark: SparkSession, d: str) -> DataFrame:
    li = load(spark, d, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("medallion"), F.col("l_partkey").alias("hack_license"),
        (F.col("l_quantity") * 60).alias("trip_time_in_secs"), F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"), F.col("l_tax").alias("tolls_amount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"))


TRIP_COLS = dict(duration="trip_time_in_secs", distance="trip_distance", fare="fare_amount", total="total_amount")


def _clean(spark, d):
    return cleaning.clean_trips(trips(spark, d), **TRIP_COLS)


def _clean_bounded(spark, d):
    t = cleaning.clean_trips(trips(spark, d), **TRIP_COLS, numeric=["tolls_amount"], min_fare=FARE_LOW,
                             max_fare=FARE_HIGH)
    return cleaning.drop_incomplete(t, ["trip_distance", "fare_amount", "trip_time_in_secs",
                                        "tolls_amount", "total_amount"])


def corpus(spark, d) -> DataFrame:
    return spread(load(spark, d, "documents").select("doc_id", "text"))


def corpus_size(spark, d):
    """N = number of corpus records, as a scalar subquery over a zero-column scan."""
    return text.line_count(load(spark, d, "documents"))


def doc_links(spark, d) -> DataFrame:
    docs = load(spark, d, "documents")
    return docs.select(F.col("doc_id").alias("page"), F.explode(F.array("lang", "source")).alias("category"))


def order_links(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("category"))


def _vocab(spark, d, size):
    return text.vocabulary(text.word_counts(corpus(spark, d)), size)


def _retrieval_tables(spark, d):
    docs = corpus(spark, d)
    vocab = text.vocabulary(text.word_counts(docs), VOCAB_RETRIEVAL)
    terms = text.doc_terms(docs, vocab, totals=True)
    idf_df = text.idf(text.doc_freq(terms), corpus_size(spark, d))
    return docs, vocab, terms, idf_df


def labelled_docs(spark, d) -> DataFrame:
    """Labelled documents (doc_id, label = quality, text)."""
    lab = load(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return lab.join(corpus(spark, d), "doc_id")


def site_table(spark, d) -> DataFrame:
    part = load(spark, d, "part")
    return part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice",
                       F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).cast("double").alias("brand_no"),
                       "p_type")


# --------------------------------------------------------------------------- sources / sinks

def scan_csv_inferred(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    path = input_path(spark, "part-csv", d)
    files.write_csv(part, path)
    return files.read_csv_inferred(spark, path)


SITE_SCHEMA = StructType([StructField("partkey", IntegerType()), StructField("name", StringType()),
                          StructField("brand", StringType()), StructField("type", StringType()),
                          StructField("size", IntegerType()), StructField("retailprice", DoubleType())])


def scan_csv_schema(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    path = input_path(spark, "part-csv", d)
    files.write_csv(part, path)
    return files.read_csv_schema(spark, path, SITE_SCHEMA)


def scan_csv_corrupt(spark, d):
    """Records with cells that do not parse, an unquoted separator inside a cell, and a missing last cell."""
    k = F.col("p_partkey")
    size = F.when(k % 7 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    price = F.when(k % 11 == 0, "12,5").when(k % 17 == 0, "").otherwise(F.col("p_retailprice").cast("string"))
    line = F.concat_ws(",", k.cast("string"), size, price)
    path = input_path(spark, "part-bad-csv", d)
    files.write_text(load(spark, d, "part").select(F.when(k % 13 == 0, line).otherwise(F.concat(line, F.lit(",x"))).alias("value")), path)
    schema = StructType([StructField("partkey", IntegerType()), StructField("size", IntegerType()),
                         StructField("price", DoubleType()), StructField("mark", StringType())])
    rows = files.read_csv_schema(spark, path, schema, corrupt_col="bad_line")
    return rows.select("partkey", "size", "price", (F.col("mark") == "x").alias("complete"), "bad_line")


def scan_text_docs(spark, d):
    lines = files.doc_lines(load(spark, d, "documents"), "doc_id", "text", "source")
    path = input_path(spark, "corpus-text", d)
    files.write_text(lines, path, LINE_SEP)
    parsed = text.parse_docs(files.read_text(spark, path, LINE_SEP))
    return parsed.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def sink_roundtrip(spark, d):
    top = ranking.top_distinct_pairs(_clean(spark, d), "medallion", "hack_license", TOP_K, "n_drivers")
    path = input_path(spark, "top10", d)
    files.write_small_result(top, path, "csv")
    schema = StructType([StructField("medallion", LongType()), StructField("n_drivers", LongType())])
    return files.read_csv_schema(spark, path, schema)


def doc_sample(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return ranking.preview(docs, "doc_id", TOP_K)


# --------------------------------------------------------------------------- cleaning

def _part_text(spark, d):
    part = load(spark, d, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"), F.col("p_name"),
        F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).alias("brand_no"), F.col("p_type"),
        F.col("p_size").cast("string").alias("p_size"), F.col("p_retailprice").cast("string").alias("p_retailprice"))


def numeric_quality(spark, d):
    t = _part_text(spark, d)
    return cleaning.numeric_quality(t, t.columns)


def line_arity(spark, d):
    """Lines of three fields whose middle one is free text, which may hold commas itself."""
    docs = load(spark, d, "documents")
    lines = docs.select("doc_id", F.concat_ws(",", F.col("doc_id").cast("string"), "text", "lang").alias("value"))
    return cleaning.line_arity(lines, 3).select("doc_id", "n_fields", "arity_ok")


def clean_trips(spark, d):
    return _clean(spark, d)


def clean_trips_bounded(spark, d):
    return _clean_bounded(spark, d)


def sigma_filter(spark, d):
    """Documents whose length, a heavy-tailed column, is within three standard deviations."""
    return cleaning.sigma_filter(load(spark, d, "documents").select("doc_id", "n_chars"), "n_chars")


def site_clean(spark, d):
    t = cleaning.with_label(site_table(spark, d), "p_type", SITE_LABELS)
    return cleaning.drop_incomplete(t, ["p_size", "p_retailprice", "brand_no", "label"]).select(
        "p_partkey", "p_size", "p_retailprice", "brand_no", "label")


def site_null_count(spark, d):
    return cleaning.null_count(cleaning.with_label(site_table(spark, d), "p_type", SITE_LABELS), "label")


def label_from_prefix(spark, d):
    docs = load(spark, d, "documents")
    return docs.select("doc_id", prefix_label("source", SOURCE_PREFIX).alias("label"))


def parse_docs(spark, d):
    """Corpus lines of which every seventh lacks its url marker and is dropped."""
    docs = load(spark, d, "documents")
    lines = files.doc_lines(docs, "doc_id", "text", "source")
    broken = F.when(F.regexp_extract("value", 'id="([0-9]+)"', 1).cast("long") % 7 == 0,
                    F.replace("value", F.lit('" url="'), F.lit('" href="'))).otherwise(F.col("value"))
    return text.parse_docs(lines.select(broken.alias("value")))


def parse_links(spark, d):
    docs = load(spark, d, "documents")
    category = F.explode(F.array("lang", "source"))
    lines = docs.select("doc_id", category.alias("c")).select(
        F.format_string('"%s","%s"', F.col("doc_id").cast("string"), F.col("c")).alias("value"))
    return files.parse_links(lines)


# --------------------------------------------------------------------------- ranking

def top_distinct_pairs(spark, d):
    return ranking.top_distinct_pairs(_clean(spark, d), "medallion", "hack_license", TOP_K, "n_drivers")


def top_mean_rate(spark, d):
    rated = cleaning.with_rate(_clean(spark, d), amount="total_amount", seconds="trip_time_in_secs")
    return ranking.top_mean(rated, "hack_license", "rate", TOP_K, "mean_rate", digits=6)


def category_counts(spark, d):
    return ranking.count_per_key(order_links(spark, d), "page", "category", "count")


def category_stats(spark, d):
    s = ranking.summary_stats(category_counts(spark, d), "count")
    return s.select(F.col("max_value").cast("long").alias("max_value"),
                    F.round("mean_value", 10).alias("mean_value"), F.round("stddev_value", 10).alias("stddev_value"))


def median_count(spark, d):
    return ranking.approx_median_sql(category_counts(spark, d), "count", "median")


def top_categories(spark, d):
    return ranking.top_by_count(order_links(spark, d), "category", "page", TOP_K, "count")


# --------------------------------------------------------------------------- text

def tokens(spark, d):
    return text.token_counts(corpus(spark, d))


def word_counts(spark, d):
    return text.word_counts(corpus(spark, d))


def vocabulary(spark, d):
    return _vocab(spark, d, VOCAB_RETRIEVAL)


def word_lookup(spark, d):
    words = spark.createDataFrame([(w,) for w in PROBE_WORDS], "word string")
    return text.word_lookup(words, _vocab(spark, d, VOCAB_LOGREG))


def doc_terms(spark, d):
    _, _, terms, _ = _retrieval_tables(spark, d)
    return terms.select("doc_id", "idx", "n")


def term_freq(spark, d):
    _, _, terms, _ = _retrieval_tables(spark, d)
    return text.term_freq(terms)


def doc_freq(spark, d):
    _, _, terms, _ = _retrieval_tables(spark, d)
    return text.doc_freq(terms)


def idf(spark, d):
    _, _, _, idf_df = _retrieval_tables(spark, d)
    return idf_df.select("idx", F.round("idf", 12).alias("idf"))


def tfidf(spark, d):
    _, _, terms, idf_df = _retrieval_tables(spark, d)
    return text.tfidf(text.term_freq(terms), idf_df).select("doc_id", "idx", F.round("weight", 12).alias("weight"))


def _queries(spark, d):
    return load(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def query_vectors(spark, d):
    _, vocab, _, idf_df = _retrieval_tables(spark, d)
    qv = retrieval.query_vectors(_queries(spark, d), vocab, idf_df, "query_id")
    return qv.select("query_id", "idx", F.round("weight", 12).alias("weight"))


def turns(spark, d) -> DataFrame:
    """Conversation turns as short queries; most share few words with any document."""
    return load(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")


def _knn(spark, d, queries):
    # The vocabulary (bounded by its size) and the term counts are read by
    # several branches, so the corpus is tokenized twice and never again.
    docs = corpus(spark, d)
    vocab = checkpoint(text.vocabulary(text.word_counts(docs), VOCAB_RETRIEVAL))
    terms = checkpoint(text.doc_terms(docs, vocab, totals=True))
    idf_df = text.idf(text.doc_freq(terms), corpus_size(spark, d))
    dvec = text.tfidf(text.term_freq(terms), idf_df)
    qvec = retrieval.query_vectors(queries(spark, d), vocab, idf_df, "query_id")
    return retrieval.cosine_topk(qvec, dvec, TOP_K)


def knn_topk(spark, d):
    return _knn(spark, d, _queries)


def knn_vote(spark, d):
    return retrieval.knn_vote(_knn(spark, d, _queries), doc_links(spark, d), TOP_K)


def knn_short(spark, d):
    """Neighbours of every conversation turn; lists that run out of shared words are filled with score 0."""
    return _knn(spark, d, turns)


# --------------------------------------------------------------------------- regression

def ols(spark, d):
    r = linear.ols(_clean_bounded(spark, d), "trip_distance", "fare_amount")
    return r.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


def _sci_rows(spark, rows, names):
    out = [(r[0], *[SCI % v for v in r[1:]]) for r in rows]
    return spark.createDataFrame(out, ", ".join([f"{names[0]} int"] + [f"{n} string" for n in names[1:]]))


def gd_line(spark, d):
    pts = cleaning.sigma_filter(_clean_bounded(spark, d), "trip_distance")
    st = linear.gram_stats(pts, ["trip_distance"], "fare_amount")
    rows = linear.gd_history(st, GD_RATE, GD_STEPS_LINE)
    return _sci_rows(spark, [r[:4] for r in rows], ["iter", "cost", "m", "b"])


# Four independent columns in comparable units (tens of days and pieces, tens of
# thousands of money), so that the descent from rate 1e-4 stays finite.
GD_MULTI_X = ["ship_day", "quantity", "fare", "tolls_amount"]


def _gd_multi_points(spark, d):
    li = load(spark, d, "lineitem")
    pts = li.select((F.dayofmonth("l_shipdate") / 10.0).alias("ship_day"), (F.col("l_quantity") / 10.0).alias("quantity"),
                    (F.col("l_extendedprice") / 10000.0).alias("fare"), F.col("l_tax").alias("tolls_amount"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 10000.0).alias("total"))
    return cleaning.drop_incomplete(pts, [*GD_MULTI_X, "total"])


def _gd_multi_rows(spark, d):
    st = linear.gram_stats(_gd_multi_points(spark, d), GD_MULTI_X, "total")
    return linear.gd_history(st, GD_RATE, GD_STEPS_MULTI, bold_driver=True)


def gd_multi(spark, d):
    """Cost and learning-rate trace of the 4-feature bold-driver descent."""
    rows = _gd_multi_rows(spark, d)
    return _sci_rows(spark, [(r[0], r[1], r[-1]) for r in rows], ["iter", "cost", "rate"])


def gd_multi_params(spark, d):
    """Parameter trace (m1..m4, b) of the same descent."""
    rows = _gd_multi_rows(spark, d)
    return _sci_rows(spark, [(r[0], *r[2:7]) for r in rows], ["iter", "m1", "m2", "m3", "m4", "b"])


# --------------------------------------------------------------------------- logistic regression

def labelled_corpus(spark, d, split: str) -> DataFrame:
    """Labelled documents (doc_id, label = quality, text) of one side of the hash split."""
    lab = load(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return lab.where(clustering.hash_split("doc_id") == split).join(corpus(spark, d), "doc_id")


def _logreg_inputs(spark, d, materialise: bool = False):
    """Dictionary, term frequencies and labels of the training documents."""
    train = labelled_corpus(spark, d, "train")
    vocab = text.vocabulary(text.word_counts(train), VOCAB_LOGREG)
    if materialise:     # bounded (<= VOCAB_LOGREG rows); read by several jobs
        vocab = checkpoint(vocab)
    return vocab, text.term_freq(text.doc_terms(train, vocab, totals=True)), train.select("doc_id", "label")


def labelled_features(spark, d):
    _, tf, lab = _logreg_inputs(spark, d)
    return lab.join(tf, "doc_id").select("doc_id", "label", "idx", "tf")


def class_weights(spark, d):
    _, _, lab = _logreg_inputs(spark, d)
    return logistic.class_weights(lab).select("label", "n", F.round("weight", 12).alias("weight"))


def _training(spark, d):
    """(vocabulary, its size, stored training table, class weights of 0 and 1)."""
    vocab, tf, lab = _logreg_inputs(spark, d, materialise=True)
    table = logistic.feature_table(lab, tf, partitions=spark.sparkContext.defaultParallelism)
    weights = {r["label"]: r["weight"] for r in logistic.class_weights(table).collect()}
    return vocab, vocab.count(), table, float(weights.get(0, 0.0)), float(weights.get(1, 0.0))


def _train(spark, d, optimizer, steps=LR_STEPS, **options):
    vocab, n_feat, table, cw0, cw1 = _training(spark, d)
    options = {"init_std": 0.0} | options
    return vocab, logistic.train_logreg(table, n_feat, cw0, cw1, optimizer=optimizer, max_iteration=steps,
                                        learning_rate=LR_RATE, regularization=LR_REG, **options)


def logreg_step(spark, d):
    """Mean weighted gradient of every word at the seeded random start."""
    _, n_feat, table, cw0, cw1 = _training(spark, d)
    gsum, _, n = logistic.step_sums(table, logistic.random_start(n_feat, LR_START_STD, LR_SEED), cw0, cw1)
    rows = [(i, round(float(g / n), 10)) for i, g in enumerate(gsum)]
    return spark.createDataFrame(rows, "idx int, gradient double")


def _history(spark, d, optimizer, **options):
    _, res = _train(spark, d, optimizer, **options)
    return spark.createDataFrame([(i + 1, round(c, 10)) for i, c in enumerate(res.costs)], "iter int, cost double")


def logreg_sgd(spark, d):
    return _history(spark, d, "SGD")


def logreg_momentum(spark, d):
    return _history(spark, d, "Momentum")


def logreg_nesterov(spark, d):
    return _history(spark, d, "Nesterov")


def logreg_adam(spark, d):
    return _history(spark, d, "Adam")


def logreg_adagrad(spark, d):
    return _history(spark, d, "Adagrad")


def logreg_rmsprop(spark, d):
    return _history(spark, d, "RMSprop")


def logreg_minibatch(spark, d):
    """Cost of each step on that step's hash sample of about LR_BATCH documents."""
    return _history(spark, d, "SGD", steps=LR_COMPARE_STEPS, batch_size=LR_BATCH)


def optimizer_costs(spark, d):
    """Last recorded training cost after at most LR_COMPARE_STEPS steps for
    each optimizer, from weights N(0, LR_START_STD) of numpy seed LR_SEED, and
    with Adam's second moment started at the vocabulary size."""
    _, n_feat, table, cw0, cw1 = _training(spark, d)
    rows = []
    for opt in LR_COMPARED:
        res = logistic.train_logreg(table, n_feat, cw0, cw1, optimizer=opt, max_iteration=LR_COMPARE_STEPS,
                                    learning_rate=LR_RATE, regularization=LR_REG, init_std=LR_START_STD, seed=LR_SEED,
                                    adam_v0=float(n_feat))
        rows.append((opt, len(res.costs), round(float(res.costs[-1]), 9) if res.costs else None))
    return spark.createDataFrame(rows, "optimizer string, steps int, final_cost double")


def logreg_predict(spark, d):
    """Predictions for the test documents: dictionary and weights come from the training ones."""
    vocab, res = _train(spark, d, "RMSprop")
    test = labelled_corpus(spark, d, "test")
    tf = text.term_freq(text.doc_terms(test, vocab, totals=True))
    table = logistic.feature_table(test.select("doc_id", "label"), tf)
    return logistic.predict(table, res.weights)


def logreg_evaluate(spark, d):
    m = metrics.binary_metrics(logreg_predict(spark, d))
    return m.select("tp", "fp", "tn", "fn", *[F.round(c, 12).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def top_weights(spark, d):
    vocab, res = _train(spark, d, "RMSprop")
    return logistic.top_weights(logistic.weights_frame(spark, res.weights), vocab, 5)


# --------------------------------------------------------------------------- metrics

def _given_predictions(spark, d):
    return load(spark, d, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def binary_metrics(spark, d):
    m = metrics.binary_metrics(_given_predictions(spark, d))
    return m.select("tp", "fp", "tn", "fn", *[F.round(c, 12).alias(c) for c in
                                                ("accuracy", "precision", "recall", "f1")])


def weighted_metrics(spark, d):
    m = metrics.weighted_metrics(_given_predictions(spark, d))
    return m.select(*[F.round(c, 12).alias(c) for c in m.columns])


def confusion_pivot(spark, d):
    return metrics.confusion_pivot(_given_predictions(spark, d), values=[0, 1])


# --------------------------------------------------------------------------- clustering

def _emb(spark, d):
    return load(spark, d, "embeddings")


def silhouette(spark, d):
    return clustering.silhouette(_emb(spark, d), "embedding", "label", digits=10)


def cluster_summary(spark, d):
    """Statistics of every dimension of the vectors per given label."""
    e = _emb(spark, d).select("label", F.posexplode("embedding").alias("dim", "x")).select(
        F.struct("label", "dim").alias("c"), F.col("x").cast("double").alias("x"))
    s = clustering.cluster_summary(e, "c", "x").withColumn("dim", F.col("cluster.dim")).withColumn(
        "cluster", F.col("cluster.label"))
    return s.select("cluster", "dim", "min_value", "max_value", F.round("mean_value", 10).alias("mean_value"),
                    F.round("stddev_value", 10).alias("stddev_value"))


def kmeans_assign(spark, d):
    return clustering.nearest_centre(_emb(spark, d), "vec_id", "embedding", KMEANS_K)


def split_hash(spark, d):
    part = load(spark, d, "part")
    return part.select("p_partkey", clustering.hash_split("p_partkey").alias("split"))


# The three feature sets, and the columns of the classifiers.
SITE_FEATURES = {"price": ["p_retailprice"], "size": ["p_size"], "size_price": ["p_size", "p_retailprice"]}
CLASS_FEATURES = ["p_size", "p_retailprice", "brand_no", "name_length"]


def _site_split(spark, d):
    """Train and test rows by a hash of the key: the same on every layout."""
    t = dealt(site_clean(spark, d))
    split = clustering.hash_split("p_partkey")
    return t.where(split == "train"), t.where(split == "test")


def _fitted_points(spark, d, make):
    """Predictions for all three feature sets on both sides of the split:
    (features, split, p_partkey, p_size, p_retailprice, prediction)."""
    train, test = _site_split(spark, d)
    out = None
    for name, cols in SITE_FEATURES.items():
        _, on_train, on_test = clustering.fit_predict(make(), cols, train, test)
        for split, points in (("train", on_train), ("test", on_test)):
            part = points.select(F.lit(name).alias("features"), F.lit(split).alias("split"), "p_partkey", "p_size",
                                 "p_retailprice", "prediction")
            out = part if out is None else out.unionByName(part)
    return out


def kmeans_points(spark, d):
    return _fitted_points(spark, d, lambda: clustering.kmeans(KMEANS_K, CLUSTER_TOL, CLUSTER_SEED))


def gmm_points(spark, d):
    return _fitted_points(spark, d, lambda: clustering.gmm(KMEANS_K, CLUSTER_TOL, CLUSTER_SEED))


def _quality(points):
    """Silhouette and per-cluster statistics of predictions, per feature set and split."""
    out = None
    for name, cols in SITE_FEATURES.items():
        for split in ("train", "test"):
            own = points.where((F.col("features") == name) & (F.col("split") == split))
            s = clustering.silhouette(own.select(F.array(*cols).alias("x"), "prediction"), "x", "prediction", digits=8)
            stats = clustering.cluster_summary(own, "prediction", "p_retailprice")
            part = stats.crossJoin(F.broadcast(s)).select(        # one row
                F.lit(name).alias("features"), F.lit(split).alias("split"), "cluster", "min_value", "max_value",
                F.round("mean_value", 8).alias("mean_value"), F.round("stddev_value", 8).alias("stddev_value"), "silhouette")
            out = part if out is None else out.unionByName(part)
    return out


def kmeans_quality(spark, d):
    return _quality(checkpoint(kmeans_points(spark, d)))


def gmm_quality(spark, d):
    return _quality(checkpoint(gmm_points(spark, d)))


def _lloyd_points(spark, d):
    train, test = _site_split(spark, d)
    out = None
    for name, cols in SITE_FEATURES.items():
        centres = clustering.lloyd(train, cols, "p_partkey", KMEANS_K, LLOYD_STEPS)
        for split, points in (("train", train), ("test", test)):
            part = clustering.assign(points, cols, centres).select(
                F.lit(name).alias("features"), F.lit(split).alias("split"), "p_partkey", "p_size", "p_retailprice",
                "prediction")
            out = part if out is None else out.unionByName(part)
    return out


def lloyd_points(spark, d):
    """k-means from fixed centres for LLOYD_STEPS steps, fitted on train, applied to both sides."""
    return _lloyd_points(spark, d)


def lloyd_quality(spark, d):
    return _quality(checkpoint(_lloyd_points(spark, d)))


def _mixtures(spark, d):
    train, _ = _site_split(spark, d)
    train = checkpoint(train.select("p_partkey", "p_size", "p_retailprice"))
    return {name: clustering.mixture_fit(train, cols, "p_partkey", KMEANS_K, MIXTURE_STEPS) for name, cols in SITE_FEATURES.items()}


def mixture_history(spark, d):
    """Mean log-likelihood of the training rows before each EM step, from a fixed start, for the three feature sets."""
    rows = [(name, step, SCI % v) for name, (_, history) in _mixtures(spark, d).items() for step, v in enumerate(history)]
    return spark.createDataFrame(rows, "features string, step int, mean_log_likelihood string")


def mixture_params(spark, d):
    """Weight, mean and variance per component and dimension after MIXTURE_STEPS EM steps."""
    rows = [(name, c, col, SCI % m.weights[c], SCI % (m.means[c, i] + m.origin[i]), SCI % m.covariances[c, i, i])
            for name, (m, _) in _mixtures(spark, d).items() for c in range(len(m.weights)) for i, col in enumerate(SITE_FEATURES[name])]
    return spark.createDataFrame(rows, "features string, component int, dim string, weight string, mean string, variance string")


def mixture_points(spark, d):
    """Components of the rows of both sides of the split under the fitted mixtures."""
    mixtures, out = _mixtures(spark, d), None
    for split, points in zip(("train", "test"), _site_split(spark, d)):
        for name, cols in SITE_FEATURES.items():
            part = mixtures[name][0].predict(points, cols).select(F.lit(name).alias("features"), F.lit(split).alias("split"),
                                                                  "p_partkey", "prediction")
            out = part if out is None else out.unionByName(part)
    return out


def lloyd_sweep(spark, d):
    """Silhouette for each k of k-means from fixed centres: the choice of k on one table of points."""
    train = checkpoint(_site_split(spark, d)[0].select("p_partkey", "p_size", "p_retailprice"))
    cols = SITE_FEATURES["size_price"]
    centres = clustering.lloyd_all(train, cols, "p_partkey", SWEEP_KS, LLOYD_STEPS)
    points = clustering.assign_all(train, cols, centres).select("k", "prediction", F.array(*cols).alias("x"))
    return clustering.silhouettes(points, "x", "prediction", ["k"]).select("k", F.round("silhouette", 8).alias("silhouette"))


def k_sweep(spark, d):
    train, _ = _site_split(spark, d)
    return clustering.k_sweep(train, ["p_size", "p_retailprice"], SWEEP_KS, CLUSTER_TOL, CLUSTER_SEED)


def site_classify(spark, d):
    names = load(spark, d, "part").select("p_partkey", F.char_length("p_name").cast("double").alias("name_length"))
    train, test = (t.join(names, "p_partkey") for t in _site_split(spark, d))
    return classify.classify_accuracy(train, test, CLASS_FEATURES, "label")


def site_fit_check(spark, d):
    """The multinomial regression's objective and gradient (below a ten-thousandth of the start's), the forest's nodes
    (impurities and gains from their class counts), and on how many test rows the prediction is not the one that the
    weights, or a replay of the forest's votes by joins, give."""
    names = load(spark, d, "part").select("p_partkey", F.char_length("p_name").cast("double").alias("name_length"))
    train, test = (checkpoint(clustering.assembler(CLASS_FEATURES).transform(t.join(names, "p_partkey")).withColumn(
        "label", F.col("label").cast("double"))) for t in _site_split(spark, d))
    made = {name: est.fit(train) for name, est in classify.classifiers("label").items()}
    regression, forest = made["logistic_regression"], made["random_forest"]
    found = fitcheck.optimality(train, "softmax", regression)
    pred = fitcheck.recomputed(regression.transform(test).select("prediction", "features"), regression.coefficientMatrix.toArray(),
                               regression.interceptVector.toArray())
    nodes = checkpoint(fitcheck.forest_nodes(spark, forest))
    votes = fitcheck.forest_votes(test, nodes, "p_partkey", CLASS_FEATURES, forest.getMaxDepth())
    voted = forest.transform(test).select("p_partkey", "prediction").join(votes, "p_partkey", "left")
    n = train.count(), test.count()
    rows = [("logistic_regression", *n, found["objective_matches"] and found["gradient_share"] < 1e-4,
             pred.where("prediction <> recomputed").count()),
            ("random_forest", *n, fitcheck.unsound_nodes(nodes).isEmpty(),
             voted.where("voted is null or prediction <> voted").count())]
    return spark.createDataFrame(rows, "model string, n_train long, n_test long, sound boolean, mismatches long")


# --------------------------------------------------------------------------- spark.ml text

def _ml_split(spark, d):
    docs = labelled_docs(spark, d).withColumn("split", clustering.hash_split("doc_id"))
    return docs.where("split = 'train'").drop("split"), docs.where("split = 'test'").drop("split")


def ml_tokens(spark, d):
    return textml.token_counts(corpus(spark, d))


def ml_stopwords(spark, d):
    return textml.token_counts(corpus(spark, d), remove_stop_words=True)


def cv_vocabulary(spark, d):
    """Vocabulary of all documents; the upper bound is a share, so it holds at every size."""
    return textml.vocabulary_frame(textml.filtered_tokens(corpus(spark, d)), min_df=ML_MIN_DF, max_df=ML_MAX_SHARE)


def ml_idf(spark, d):
    docs = corpus(spark, d)
    model = textml.fit_text_features(docs, min_df=ML_MIN_DF, max_df=ML_MAX_SHARE)
    return textml.idf_table(model, spark).select("term", F.round("idf", 12).alias("idf"))


def _ml_features(spark, d):
    """(model, train features, test features): tokens are cut once, features stored once."""
    train, test = _ml_split(spark, d)
    model = textml.fit_text_features(train)
    return (model, *(checkpoint(model.transform(t).select("doc_id", "features", F.col("label").cast("double").alias("label")))
                     for t in (train, test)))


def _chi2(spark, model, train):
    return textml.chi2_table(train, textml.vocabulary_table(model, spark))


def chi2_stats(spark, d):
    """Chi-squared statistic and degrees of freedom of every vocabulary term."""
    model, train, _ = _ml_features(spark, d)
    return _chi2(spark, model, train).select("term", F.round("statistic", 8).alias("statistic"), F.col("dof").cast("int").alias("dof"))


def chi2_selected(spark, d):
    """The ML_SELECTED terms with the smallest p-values, in that order."""
    model, train, _ = _ml_features(spark, d)
    return textml.top_features(_chi2(spark, model, train), ML_SELECTED).select(
        "rank", "term", F.round("statistic", 8).alias("statistic"), F.col("dof").cast("int").alias("dof"))


def _ml_predictions(spark, d, *kinds):
    """(model, n_features, doc_id, label, prediction) of the test documents, with all features and with the
    selected ones; features and selection are made once for all kinds of model."""
    model, train, test = _ml_features(spark, d)
    chosen = [r["idx"] for r in textml.top_features(_chi2(spark, model, train), ML_SELECTED).collect()]
    cut = textml.slicer(chosen)
    out = None
    for kind in kinds:
        make = textml.logistic if kind == "logreg" else textml.linear_svc
        for n, col, tr, te in ((5000, "features", train, test),
                               (ML_SELECTED, "chosen", cut.transform(train), cut.transform(test))):
            part = make(col).fit(tr).transform(te).select(F.lit(kind).alias("model"), F.lit(n).alias("n_features"), "doc_id",
                                                          "label", "prediction")
            out = part if out is None else out.unionByName(part)
    return checkpoint(out)


def _ml_eval(spark, d, kind):
    pred = _ml_predictions(spark, d, kind)
    rows = []
    for n in (5000, ML_SELECTED):
        m = metrics.weighted_metrics(pred.where(F.col("n_features") == n), "label", "prediction").first()
        rows.append((kind, n, *[float(v) if v is not None else None for v in m]))
    return spark.createDataFrame(rows, "model string, n_features int, accuracy double, weighted_precision double, "
                                       "weighted_recall double, weighted_f1 double")


def ml_fit_check(spark, d):
    """Both classifiers with all and with the selected features: whether the objective recomputed from the training rows
    is the one the fit ended with, whether the gradient there is below a twentieth of the one at the start (20 iterations),
    and on how many test rows the prediction is not the one that the weights give."""
    model, train, test = _ml_features(spark, d)
    chosen = [r["idx"] for r in textml.top_features(_chi2(spark, model, train), ML_SELECTED).collect()]
    cut = textml.slicer(chosen)
    n_train, n_test, rows = train.count(), test.count(), []
    for kind, loss, make in (("logreg", "logistic", textml.logistic), ("svm", "hinge", textml.linear_svc)):
        for n, col, tr, te in ((5000, "features", train, test), (ML_SELECTED, "chosen", cut.transform(train), cut.transform(test))):
            tr, te = (t.select("doc_id", F.col(col).alias("features"), "label") for t in (tr, te))
            fit = make().fit(tr)
            found = fitcheck.optimality(tr, loss, fit)
            pred = fitcheck.recomputed(fit.transform(te).select("prediction", "features"), fit.coefficients.toArray(), [fit.intercept])
            rows.append((kind, n, n_train, n_test, found["objective_matches"], found["gradient_share"] < 0.05,
                         pred.where("prediction <> recomputed").count()))
    return spark.createDataFrame(rows, "model string, n_features int, n_train long, n_test long, objective_matches boolean, "
                                       "gradient_small boolean, mismatches long")


def ml_logreg(spark, d):
    return _ml_eval(spark, d, "logreg")


def ml_svm(spark, d):
    return _ml_eval(spark, d, "svm")


def ml_confusion(spark, d):
    """Confusion matrix of both models with all and with the selected features."""
    out = _ml_predictions(spark, d, "logreg", "svm").groupBy("model", "n_features", F.col("label").cast("int").alias("label")).pivot(
        "prediction", [0.0, 1.0]).count().na.fill(0)
    return out.select("model", "n_features", "label", F.col("`0.0`").alias("predicted_0"), F.col("`1.0`").alias("predicted_1"))
