"""Evaluation metrics as one-pass aggregates over (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _ratio(num, den):
    """num / den, 0 when den is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn, accuracy, precision, recall, f1
    (f1 = tp / (tp + (fp + fn) / 2); every ratio is 0 when undefined)."""
    l, p = F.col(label), F.col(prediction)
    counts = df.agg(F.count_if((l == 1) & (p == 1)).alias("tp"), F.count_if((l == 0) & (p == 1)).alias("fp"),
                    F.count_if((l == 0) & (p == 0)).alias("tn"), F.count_if((l == 1) & (p == 0)).alias("fn"),
                    F.count(F.lit(1)).alias("n"))
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    return counts.select(
        "tp", "fp", "tn", "fn",
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp, tp.cast("double") + F.lit(0.5) * (fp + fn)).alias("f1"),
    )


def confusion_pivot(df: DataFrame, label: str = "label", prediction: str = "prediction",
                    values: Sequence = (0, 1)) -> DataFrame:
    """label x prediction counts, one column per given prediction value,
    missing cells 0, ordered by label."""
    return (df.groupBy(label).pivot(prediction, list(values)).count()
            .na.fill(0).orderBy(label))


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and label-frequency-weighted precision, recall, F1
    over the classes present in ``label`` (as MulticlassClassificationEvaluator
    'accuracy', 'weightedPrecision', 'weightedRecall', 'f1')."""
    cells = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # k x k cells, both marginals from windows over them: one pass over the rows
    cells = cells.withColumns({"lab": F.sum("n").over(Window.partitionBy("l")),
                               "pred": F.sum("n").over(Window.partitionBy("p"))})
    hit = F.col("l") == F.col("p")
    per = cells.groupBy("l").agg(F.max("lab").alias("lab"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("tp"),
                                 F.coalesce(F.max(F.when(hit, F.col("pred"))), F.lit(0)).alias("pred"))
    prec = _ratio(F.col("tp"), F.col("pred"))
    rec = _ratio(F.col("tp"), F.col("lab"))
    per = per.select("lab", "tp", prec.alias("pc"), rec.alias("rc"))
    f1 = F.when(F.col("pc") + F.col("rc") == 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.col("pc") * F.col("rc") / (F.col("pc") + F.col("rc")))
    per = per.withColumn("fc", f1)
    total = F.sum("lab").cast("double")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("pc") * F.col("lab")) / total).alias("weighted_precision"),
        (F.sum(F.col("rc") * F.col("lab")) / total).alias("weighted_recall"),
        (F.sum(F.col("fc") * F.col("lab")) / total).alias("weighted_f1"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double"))
                  .alias("accuracy"))
