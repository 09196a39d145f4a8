import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(E.QUERY_NAMES) == len(set(E.QUERY_NAMES))
    assert set(E.QUERY_NAMES) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "category", "votes"]
    assert df.count() >= 0


def test_oracle_sql_parses():
    con = duckdb.connect()
    for t in ["part", "lineitem", "documents", "labels", "benchmark", "embeddings", "pages", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")


def test_some_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in ["lineitem", "documents", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ["top_distinct_pairs", "vocabulary", "binary_metrics", "parse_links"]:
        a = sorted(tuple(r) for r in E.queries()[name](spark, SMOKE).collect())
        b = sorted(tuple(r) for r in con.execute(E.oracle_sql()[name]).fetchall())
        assert a == b, name
