import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from tessera.operators import metrics


def _pairs(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4      # TP 3, FP 1, FN 2, TN 4
    return spark.createDataFrame(rows, "label int, prediction int")


def test_binary_fixture(spark):
    r = metrics.binary_metrics(_pairs(spark)).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (3, 1, 4, 2)
    assert r.accuracy == pytest.approx(0.7) and r.precision == pytest.approx(0.75)
    assert r.recall == pytest.approx(0.6) and r.f1 == pytest.approx(2 / 3)


def test_binary_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = metrics.binary_metrics(df).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_confusion_pivot(spark):
    got = [tuple(r) for r in metrics.confusion_pivot(_pairs(spark)).collect()]
    assert got == [(0, 4, 1), (1, 2, 3)]
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    assert [tuple(r) for r in metrics.confusion_pivot(df).collect()] == [(0, 1, 0), (1, 1, 0)]


@pytest.mark.parametrize("name,col", [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                                      ("weightedRecall", "weighted_recall"), ("f1", "weighted_f1")])
def test_weighted_metrics_equal_evaluator(spark, name, col):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 2.0)] + [(2.0, 2.0)] * 4 + [(2.0, 0.0)] * 2
    df = spark.createDataFrame(rows, "label double, prediction double")
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
    assert metrics.weighted_metrics(df).first()[col] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_weighted_recall_is_accuracy(spark):
    r = metrics.weighted_metrics(_pairs(spark)).first()
    assert r.weighted_recall == pytest.approx(r.accuracy)
