"""Multi-class classification of assembled numeric features
(multinomial logistic regression, random forest) with accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame

from tessera.operators.clustering import assembler
from tessera.operators.metrics import accuracy


def classifiers(label_col: str = "label", seed: int = 42):
    return {
        "logistic_regression": LogisticRegression(featuresCol="features", labelCol=label_col),
        "random_forest": RandomForestClassifier(featuresCol="features", labelCol=label_col, seed=seed),
    }


def classify_accuracy(train: DataFrame, test: DataFrame, cols: Sequence[str], label_col: str = "label",
                      seed: int = 42) -> DataFrame:
    """(model, accuracy) on the test rows for each classifier."""
    spark = train.sparkSession
    rows = []
    for name, est in classifiers(label_col, seed).items():
        model = Pipeline(stages=[assembler(cols), est]).fit(train)
        acc = accuracy(model.transform(test), label_col, "prediction").first()[0]
        rows.append((name, float(acc)))
    return spark.createDataFrame(rows, "model string, accuracy double")
