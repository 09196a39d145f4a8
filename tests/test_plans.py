"""Plan-shape checks for the properties the design relies on at scale."""

from pyspark.sql import functions as F

from tessera.operators import clustering, ranking, text
from tessera.plans import bindings as B

SMOKE = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = _plan(B.clean_trips_bounded(spark, SMOKE))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_extendedprice,1000.0)" in p and "LessThan(l_extendedprice,60000.0)" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "l_orderkey" not in scan and "l_shipdate" not in scan and "l_returnflag" not in scan


def test_aggregates_are_partial_before_the_shuffle(spark):
    p = _plan(text.word_counts(B.corpus(spark, SMOKE)))
    assert "partial_count" in p and p.index("Exchange hashpartitioning(word") < p.index("partial_count")


def test_top_k_per_group_limits_before_the_shuffle(spark):
    # one hot group holding a third of the rows
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("g"),
                                  (F.col("id") * 7 % 101).alias("v"))
    out = ranking.top_k_per_group(df, ["g"], [F.desc("v")], 5)
    p = _plan(out)
    assert "WindowGroupLimit" in p and "Partial" in p
    assert out.where("g = 0").count() == 5


def test_vocabulary_is_broadcast(spark):
    docs = B.corpus(spark, SMOKE)
    vocab = text.vocabulary(text.word_counts(docs), 100)
    p = _plan(text.doc_terms(docs, vocab))
    assert "BroadcastHashJoin" in p and "TakeOrderedAndProject(limit=100" in p


def test_no_cartesian_products(spark):
    for df in (clustering.silhouette(B._emb(spark, SMOKE), "embedding", "label"),
               clustering.nearest_centre(B._emb(spark, SMOKE), "vec_id", "embedding", 3),
               B.sigma_filter(spark, SMOKE), B.category_stats(spark, SMOKE)):
        p = _plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_logistic_step_shuffles_only_partials(spark):
    import numpy as np
    from tessera.operators import logistic
    tf = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5), (2, 1, 1.0)], "doc_id long, idx int, tf double")
    lab = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    train = logistic.feature_table(lab, tf)
    g, c, n = logistic.step_sums(train, np.zeros(2), 1.0, 1.0)
    assert n == 3 and np.allclose(g, [0.5 * -0.5, 0.5 * -0.5 + 1.0 * 0.5])
    assert abs(c - 3 * np.log(2)) < 1e-12
