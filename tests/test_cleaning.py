import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.columns import is_float_text, label_map, prefix_label
from tessera.operators import cleaning, ranking

# FIXTURES.md section 1: trip rows a-g (used positions only), as CSV strings
ROWS = [  # key, [0], [1], [4], [5], [11], [15], [16]
    ("a", "m1", "d1", "120", "1.0", "10", "0", "12"),
    ("b", "m1", "d2", "60", "1.0", "10", "0", "12"),
    ("c", "m1", "d2", "600", "2.0", "0.5", "0", "3"),
    ("d", "m2", "d1", "300", "3.0", "600", "0", "600"),
    ("e", "m2", "d1", "300", "abc", "20", "0", "22"),
    ("f", "m2", None, "300", "1.0", "20", "x", "22"),
    ("g", "m3", "d3", None, "1.0", "20", "0", "22"),
]
COLS = ["row", "medallion", "hack", "secs", "dist", "fare", "tolls", "total"]
TRIP = dict(duration="secs", distance="dist", fare="fare", total="total")


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, COLS)


def test_basic_filter(trips):
    kept = sorted(r.row for r in cleaning.clean_trips(trips, **TRIP).collect())
    assert kept == ["a", "c", "d", "f"]


def test_bounded_filter(trips):
    out = cleaning.clean_trips(trips, **TRIP, numeric=["tolls"], min_fare=1, max_fare=600)
    assert [r.row for r in out.collect()] == ["a"]


def test_distinct_pairs_count_null_partner(trips):
    clean = cleaning.clean_trips(trips, **TRIP)
    got = {r.medallion: r.n for r in ranking.distinct_pair_counts(clean, "medallion", "hack", "n").collect()}
    assert got == {"m1": 2, "m2": 2}


def test_mean_rate(trips):
    clean = cleaning.with_rate(cleaning.clean_trips(trips, **TRIP), amount="total", seconds="secs")
    got = {r.hack: r.mean for r in ranking.mean_per_key(clean, "hack", "rate", "mean").collect()}
    assert got["d1"] == pytest.approx(63.0) and got["d2"] == pytest.approx(0.3) and got[None] == pytest.approx(4.4)


def test_top_k_ties_broken_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, v int")
    got = [r.k for r in ranking.top_k(df, [F.desc("v"), F.asc("k")], 2).collect()]
    assert got == ["c", "a"]


@pytest.mark.parametrize("value,ok", [
    ("1", True), (" 2.5 ", True), ("1e5", True), ("-1E-3", True), (".5", True), ("5.", True),
    ("nan", True), ("inf", True), ("-Infinity", True), ("\t7\n", True),
    ("abc", False), ("1.5d", False), ("", False), (None, False), ("1..2", False), ("e5", False)])
def test_numeric_validity(spark, value, ok):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(is_float_text("v")).first()[0] is ok


def test_nan_never_passes(spark):
    df = spark.createDataFrame([(120.0, 1.0, float("nan"), 5.0)], "secs double, dist double, fare double, total double")
    assert cleaning.clean_trips(df, **TRIP).count() == 0


def test_numeric_quality_counts(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", "3"), (None, "4")], "a string, b string")
    got = {r.column_name: (r.n_valid, r.n_invalid) for r in cleaning.numeric_quality(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 1), "b": (2, 1)}


def test_line_arity(spark):
    lines = spark.createDataFrame([(",".join(["x"] * 17),), (",".join(["x"] * 16),), ("a,,,",)], "value string")
    got = [(r.n_fields, r.arity_ok) for r in cleaning.line_arity(lines, 17).collect()]
    assert got == [(17, True), (16, False), (4, False)]


def test_sigma_filter_inclusive(spark):
    vals = [0.0] * 20 + [100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    m = sum(vals) / len(vals)
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / (len(vals) - 1))
    expected = [v for v in vals if m - 3 * sd <= v <= m + 3 * sd]
    assert sorted(r.x for r in cleaning.sigma_filter(df, "x").collect()) == sorted(expected)


def test_labels(spark):
    df = spark.createDataFrame([("airport", "AU1"), ("port", "x"), ("heliport", None)], "t string, id string")
    got = df.select(label_map("t", {"airport": 1, "station": 2, "port": 3, "unknown": 4}).alias("l"),
                    prefix_label("id", "AU").alias("p")).collect()
    assert [(r.l, r.p) for r in got] == [(1, 1), (3, 0), (None, 0)]


def test_null_count_and_dropna(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, 1.0)], "a int, b double")
    assert cleaning.null_count(df, "b").first().n_null == 1
    assert cleaning.drop_incomplete(df, ["a", "b"]).count() == 1
