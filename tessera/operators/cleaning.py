"""Record cleaning and quality checks (delimited trip records, site tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tessera.functions.columns import is_numeric, label_map, safe_div, to_double


def numeric_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: how many cells pass / fail the numeric-validity test.

    One pass: all counts come out of a single global aggregate (partial
    aggregation per task, one row shuffled per task), then unpivoted.
    """
    aggs = []
    for c in columns:
        ok = is_numeric(df, c)
        aggs += [F.count_if(ok).alias(f"{c}__valid"), F.count_if(~ok).alias(f"{c}__invalid")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__valid`, `{c}__invalid`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, n_valid, n_invalid)")


def line_arity(lines: DataFrame, n_fields: int, sep: str = ",", value_col: str = "value") -> DataFrame:
    """Adds ``n_fields`` (fields per line, trailing empties kept) and
    ``arity_ok`` (= exactly ``n_fields``)."""
    cnt = F.size(F.split(F.col(value_col), _regex_quote(sep), -1))
    return lines.withColumn("n_fields", cnt).withColumn("arity_ok", cnt == F.lit(n_fields))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def clean_trips(df: DataFrame, *, duration: str, distance: str, fare: str, total: str,
                numeric: Sequence[str] = (), min_duration: float = 60.0,
                min_distance: float = 0.0, min_fare: float = 0.0,
                max_fare: float | None = None, min_total: float = 0.0,
                required: Sequence[str] = ()) -> DataFrame:
    """Keep trip records that pass the validity rules.

    * every column in ``numeric`` (plus distance and fare) passes the numeric test;
    * duration > min_duration, distance > min_distance, fare > min_fare,
      total > min_total and, when given, fare < max_fare;
    * NaN never passes a comparison (``NOT isnan``), null rejects the row;
    * ``required`` columns must be non-null.

    A pure ``filter``: Catalyst pushes the typed predicates into the scan.
    """
    checks = [is_numeric(df, c) for c in dict.fromkeys([distance, fare, *numeric])]
    vals = {c: to_double(df, c) for c in (duration, distance, fare, total)}

    def gt(c, bound):
        v = vals[c]
        return v.isNotNull() & ~F.isnan(v) & (v > F.lit(float(bound)))

    cond = gt(duration, min_duration) & gt(distance, min_distance) & gt(fare, min_fare) & gt(total, min_total)
    if max_fare is not None:
        cond = cond & (vals[fare] < F.lit(float(max_fare)))
    for c in checks:
        cond = cond & c
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def with_rate(df: DataFrame, *, amount: str, seconds: str, out: str = "rate") -> DataFrame:
    """amount per minute: amount / (seconds / 60); null when seconds is 0."""
    return df.withColumn(out, safe_div(F.col(amount).cast("double"), F.col(seconds).cast("double") / F.lit(60.0)))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``columns`` removed."""
    return df.dropna(subset=list(columns))


def null_count(df: DataFrame, column: str) -> DataFrame:
    """One row: number of nulls in ``column``."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_null"))


def with_label(df: DataFrame, source: str, mapping: dict, out: str = "label") -> DataFrame:
    """Conditional label: value -> label via a CASE chain, unmatched -> null."""
    return df.withColumn(out, label_map(source, mapping))


def sigma_filter(df: DataFrame, column: str, n_sigma: float = 3.0) -> DataFrame:
    """Keep rows with mean - n*sd <= value <= mean + n*sd (sample sd, inclusive).

    The two statistics are scalar subqueries: Spark runs the one-row
    aggregate once and inlines the result, so the filter needs neither a
    join nor a driver round trip.
    """
    stats = df.agg(F.avg(column).alias("m"), F.stddev_samp(column).alias("s"))
    lo = stats.select(F.col("m") - F.lit(n_sigma) * F.col("s")).scalar()
    hi = stats.select(F.col("m") + F.lit(n_sigma) * F.col("s")).scalar()
    return df.where((F.col(column) >= lo) & (F.col(column) <= hi))
