"""spark.ml fits: layout independence, sanity on separable data, selection against Spark's own selector."""
import numpy as np
import pytest
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tessera.operators import classify, clustering, metrics, textml
from tessera.plans import bindings as B
from tessera.session import shared_dir

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(3 * i + c, float(10 * c + rng.normal()), float(-7 * c + rng.normal()), c) for i in range(40) for c in range(3)]
    return spark.createDataFrame(rows, "id long, x double, y double, c int")


@pytest.mark.parametrize("query", [B.kmeans_points, B.gmm_points, B.lloyd_points])
def test_same_answer_on_other_shuffle_settings(spark, query):
    found = []
    for n in ("4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(tuple(r) for r in query(spark, SMOKE).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and {r[0] for r in found[0]} == set(B.SITE_FEATURES) and {r[1] for r in found[0]} == {"train", "test"}


@pytest.mark.parametrize("make", [clustering.kmeans, clustering.gmm])
def test_fits_find_separate_blobs(blobs, make):
    _, train, test = clustering.fit_predict(make(3), ["x", "y"], blobs.where("id % 4 > 0"), blobs.where("id % 4 = 0"))
    for pred in (train, test):
        pairs = {(r.c, r.prediction) for r in pred.select("c", "prediction").distinct().collect()}
        assert len(pairs) == len({c for c, _ in pairs}) == 3


def test_lloyd_and_sweep(blobs):
    centres = clustering.lloyd(blobs, ["x", "y"], "id", 3, 5)
    assert np.allclose(sorted(centres), [[0, 0], [10, -7], [20, -14]], atol=0.6)
    got = clustering.assign(blobs, ["x", "y"], centres).groupBy("c").agg(F.countDistinct("prediction").alias("n")).collect()
    assert [r.n for r in got] == [1, 1, 1]
    sweep = {(r.model, r.k): r.silhouette for r in clustering.k_sweep(blobs, ["x", "y"], range(2, 5)).collect()}
    assert max(range(2, 5), key=lambda k: sweep["kmeans", k]) == 3 and sweep["gmm", 3] > 0.9


def test_a_centre_without_points_stays(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 9.0)], "id long, x double")
    assert clustering.assign(df, ["x"], [[1.0], [1.0]]).select("prediction").distinct().first()[0] == 0


def test_classifiers(blobs):
    got = {r.model: r.accuracy for r in classify.classify_accuracy(blobs.where("id % 4 > 0"), blobs.where("id % 4 = 0"),
                                                                    ["x", "y"], "c").collect()}
    assert set(got) == {"logistic_regression", "random_forest"} and min(got.values()) > 0.95


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(1)
    common, good, bad = [f"w{i}" for i in range(30)], [f"g{i}" for i in range(8)], [f"b{i}" for i in range(8)]
    rows = []
    for i in range(120):
        y = i % 2
        words = [*rng.choice(common, 12), *rng.choice(good if y else bad, 4), "the"]
        rows.append((i, " ".join(rng.permutation(words)), y))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_text_models(spark, texts):
    model = textml.fit_text_features(texts.where("doc_id < 90"), min_df=2)
    vocab = textml.vocabulary_table(model, spark)
    assert "the" not in {r.term for r in vocab.collect()}
    tr, te = (model.transform(texts.where(c)).select("features", F.col("label").cast("double").alias("label"))
              for c in ("doc_id < 90", "doc_id >= 90"))
    chi2 = textml.chi2_table(tr, vocab)
    top = [r.idx for r in textml.top_features(chi2, 16).collect()]
    spark_pick = UnivariateFeatureSelector(featuresCol="features", outputCol="o", labelCol="label", selectionMode="numTopFeatures")
    spark_pick.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(16)
    assert len(set(top) & set(spark_pick.fit(tr).selectedFeatures)) >= 15          # equal p-values may swap the last
    cut = textml.slicer(top)
    for make in (textml.logistic, textml.linear_svc):
        for col, a, b in (("features", tr, te), ("chosen", cut.transform(tr), cut.transform(te))):
            pred = make(col).fit(a).transform(b)
            assert metrics.weighted_metrics(pred).first().accuracy > 0.9


def test_chi2_equals_sparks_own_test(spark):
    """Statistics, degrees of freedom and p-values of spark.ml's test, on sparse and dense vectors, three labels, constant columns."""
    rng = np.random.default_rng(4)
    rows = [(Vectors.dense(v) if i % 2 else Vectors.sparse(5, {j: x for j, x in enumerate(v) if x}), float(y))
            for i in range(200) for y in [i % 3]
            for v in [[float(rng.integers(0, 4)), float(y == 1) * rng.integers(0, 3), 0.0, 2.5, float(rng.integers(0, 40)) / 7]]]
    df = spark.createDataFrame(rows, ["features", "label"])
    vocab = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "idx int, term string")
    want = {r.featureIndex: r for r in ChiSquareTest.test(df, "features", "label", flatten=True).collect()}
    for r in textml.chi2_table(df, vocab).collect():
        assert (r.dof, r.statistic) == (want[r.idx].degreesOfFreedom, pytest.approx(want[r.idx].statistic, abs=1e-9))
        assert r.p_value == pytest.approx(want[r.idx].pValue, abs=1e-10)


def test_chi2_of_many_values(spark):
    """More distinct values than spark.ml's own test takes."""
    n = 12_000
    df = spark.range(n).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    r = textml.chi2_table(df, spark.createDataFrame([(0, "a")], "idx int, term string")).first()
    assert (r.dof, r.statistic) == (n - 1, pytest.approx(n)) and 0.4 < r.p_value < 0.6
    with pytest.raises(ValueError, match="labels"):
        textml.chi2_table(df.withColumn("label", F.col("x")), spark.createDataFrame([(0, "a")], "idx int, term string"))


def test_term_stats_in_one_pass(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b"],), ([],)], "filtered array<string>")
    assert sorted(tuple(r) for r in textml.term_stats(df).collect()) == [("a", 2, 1), ("b", 2, 2)]


def test_text_model_queries(spark):
    rows = B.ml_confusion(spark, SMOKE).collect()
    assert {(r.model, r.n_features) for r in rows} == {(m, n) for m in ("logreg", "svm") for n in (200, 5000)}
    assert len({sum(r.predicted_0 + r.predicted_1 for r in rows if (r.model, r.n_features) == k)
                for k in {(r.model, r.n_features) for r in rows}}) == 1
    assert B.ml_logreg(spark, SMOKE).count() == 2
    top = B.chi2_selected(spark, SMOKE).collect()
    assert [r["rank"] for r in top] == list(range(1, len(top) + 1)) and len(top) <= 200


def test_shared_folder_is_required_off_local_masters():
    class Context:
        master = "spark://host:1"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError):
        shared_dir(Session())
