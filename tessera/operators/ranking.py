"""Ranked aggregates and distribution statistics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k; planned as TakeOrderedAndProject (per-task heaps of k
    rows, merged once), never a full sort."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top-k rows inside each group.  ``row_number() <= k`` lets Spark insert a
    partial WindowGroupLimit before the shuffle, so a hot group sends at most
    k rows per task across the network."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def distinct_pair_counts(df: DataFrame, key: str, other: str, out: str = "n_distinct") -> DataFrame:
    """Number of distinct (key, other) pairs per key.  A null ``other`` is a
    value of its own (distinct rows, then count), unlike COUNT(DISTINCT)."""
    return df.select(key, other).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(out))


def top_distinct_pairs(df: DataFrame, key: str, other: str, k: int = 10,
                       out: str = "n_distinct") -> DataFrame:
    """Top-k keys by number of distinct partners; ties by key ascending."""
    counts = distinct_pair_counts(df, key, other, out)
    return top_k(counts, [F.desc(out), F.asc(key)], k)


def mean_per_key(df: DataFrame, key: str, value: str, out: str = "mean") -> DataFrame:
    """Mean of ``value`` per key (partial sums and counts combine map-side)."""
    return df.groupBy(key).agg(F.avg(value).alias(out))


def top_mean(df: DataFrame, key: str, value: str, k: int = 10, out: str = "mean",
             digits: int | None = None) -> DataFrame:
    """Top-k keys by mean value; ranked on the value rounded to ``digits``
    (when given), ties by key ascending."""
    means = mean_per_key(df, key, value, out)
    if digits is not None:
        means = means.withColumn(out, F.round(out, digits))
    return top_k(means, [F.desc(out), F.asc(key)], k)


def count_per_key(df: DataFrame, key: str, counted: str, out: str = "count") -> DataFrame:
    """Non-null ``counted`` values per key."""
    return df.groupBy(key).agg(F.count(counted).alias(out))


def summary_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: max, mean and sample standard deviation of ``column``."""
    return df.agg(F.max(column).alias("max_value"), F.avg(column).alias("mean_value"),
                  F.stddev_samp(column).alias("stddev_value"))


def approx_median_sql(df: DataFrame, column: str, out: str = "median", accuracy: int = 10000) -> DataFrame:
    """Approximate median through a temp view and SQL text; returns an
    element of the data (``percentile_approx``)."""
    view = f"tessera_median_{uuid.uuid4().hex[:12]}"
    spark = df.sparkSession
    df.createOrReplaceTempView(view)
    try:
        # the SQL is analysed at once; the view is not needed afterwards
        return spark.sql(f"SELECT percentile_approx(`{column}`, 0.5, {int(accuracy)}) AS `{out}` FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)


def top_by_count(df: DataFrame, key: str, counted: str, k: int = 10, out: str = "count") -> DataFrame:
    """Top-k keys by number of non-null ``counted`` values; ties by key."""
    return top_k(count_per_key(df, key, counted, out), [F.desc(out), F.asc(key)], k)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by ``key`` (a bounded preview, not a full sort)."""
    return top_k(df, [F.asc(key)], n)
