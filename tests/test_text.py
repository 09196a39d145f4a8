import math

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import ranking, retrieval, text
from tessera.sources import files

LINES = ['<doc id="AU1" url="u">Sport, SPORT ball2ball</doc>', '<doc id="7" url="u">123 --</doc>', "plain text"]


@pytest.fixture(scope="module")
def corpus(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    return lines, text.parse_docs(lines)


def test_parse(corpus):
    _, docs = corpus
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [("7", "123 --"), ("AU1", "Sport, SPORT ball2ball")]


def test_tokens(corpus):
    _, docs = corpus
    got = {r.doc_id: r.words for r in text.tokens(docs).collect()}
    assert got == {"AU1": ["sport", "sport", "ball", "ball"], "7": []}


def test_tfidf_chain(corpus):
    lines, docs = corpus
    vocab = text.vocabulary(text.word_counts(docs), 20000)
    assert [(r.word, r.idx) for r in vocab.orderBy("idx").collect()] == [("ball", 0), ("sport", 1)]
    terms = text.doc_terms(docs, vocab)
    tf = text.term_freq(terms)
    assert sorted((r.doc_id, r.idx, r.tf) for r in tf.collect()) == [("AU1", 0, 0.5), ("AU1", 1, 0.5)]
    n = text.line_count(lines)                       # N counts every line, even rejected ones
    idf = text.idf(text.doc_freq(terms), n)
    assert all(r.idf == pytest.approx(math.log(3 / 2)) for r in idf.collect())
    w = text.tfidf(tf, idf)
    assert all(r.weight == pytest.approx(0.202733, abs=1e-6) for r in w.collect())
    spark = docs.sparkSession
    q = spark.createDataFrame([(1, "ball sport"), (2, "ball"), (3, "nothing known")], "query_id long, text string")
    qv = retrieval.query_vectors(q, vocab, idf)
    top = retrieval.cosine_topk(qv, w, 1)
    got = {r.query_id: (r.doc_id, r.score) for r in top.collect()}
    assert got[1] == ("AU1", pytest.approx(1.0)) and got[2] == ("AU1", pytest.approx(0.707107, abs=1e-6))
    assert 3 not in got                               # no vocabulary word: empty result


def test_word_lookup_unknown_is_null(spark):
    docs = spark.createDataFrame([(1, "a b b")], "doc_id long, text string")
    vocab = text.vocabulary(text.word_counts(docs), 10)
    words = spark.createDataFrame([("b",), ("zzz",)], "word string")
    assert {r.word: r.idx for r in text.word_lookup(words, vocab).collect()} == {"b": 0, "zzz": None}


def test_links_and_category_stats(spark):
    lines = spark.createDataFrame([('"1","A"',), ('"1","B"',), ('"2","A"',), ('"3","A, x"',)], "value string")
    links = files.parse_links(lines)
    assert sorted(r.category for r in links.collect()) == ["A", "A", "A", "B"]
    counts = ranking.count_per_key(links, "page", "category", "count")
    s = ranking.summary_stats(counts, "count").first()
    assert (s.max_value, s.mean_value, s.stddev_value) == (2, pytest.approx(4 / 3), pytest.approx(0.577350, abs=1e-6))
    assert ranking.approx_median_sql(counts, "count").first().median == 1
    top = ranking.top_by_count(links, "category", "page", 10, "count")
    assert [(r["category"], r["count"]) for r in top.collect()] == [("A", 3), ("B", 1)]


def test_vocabulary_size_larger_than_distinct(spark):
    docs = spark.createDataFrame([(1, "x y z")], "doc_id long, text string")
    assert text.vocabulary(text.word_counts(docs), 20000).count() == 3


def test_partitioning_does_not_change_counts(spark):
    docs = spark.createDataFrame([(i, " ".join(["w%d" % (i % 5)] * (i + 1))) for i in range(40)], "doc_id long, text string")
    a = sorted(tuple(r) for r in text.word_counts(docs).collect())
    b = sorted(tuple(r) for r in text.word_counts(docs.repartition(7)).collect())
    assert a == b


def _vectors(rng, n, words, cells):
    return {i: {int(w): float(rng.randint(1, 4)) for w in rng.choice(words, size=rng.randint(1, cells), replace=False)} for i in range(n)}


def _cells(spark, vectors, key, kind="long"):
    rows = [(str(i) if kind == "string" else i, w, x) for i, v in vectors.items() for w, x in v.items()]
    return spark.createDataFrame(rows, f"{key} {kind}, idx int, weight double")


def _neighbours(asked, docs, k):
    """query -> [(doc, score)] by comparing every pair."""
    def cosine(a, b):
        norm = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return round(sum(x * b.get(w, 0.0) for w, x in a.items()) / norm, 10) if norm else 0.0
    return {q: sorted(((d, cosine(v, u)) for d, u in docs.items()), key=lambda r: (-r[1], r[0]))[:k] for q, v in asked.items()}


@pytest.mark.parametrize("small", [False, True])
def test_knn_matches_brute_force(spark, monkeypatch, small):
    """Ties, documents without a shared word, zero vectors; one group, and many shards and parts."""
    if small:
        for name, value in (("SHARD_DOCS", 9), ("PART_QUERIES", 5), ("QUERY_BLOCK", 2), ("DENSE_ROWS", 3)):
            monkeypatch.setattr(retrieval, name, value)
    rng = np.random.RandomState(3)
    docs, asked = _vectors(rng, 60, 40, 5), _vectors(rng, 23, 40, 4)
    docs[60], asked[23] = {1: 0.0}, {2: 0.0}
    got = {}
    for r in retrieval.cosine_topk(_cells(spark, asked, "query_id"), _cells(spark, docs, "doc_id"), 7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    for q, want in _neighbours(asked, docs, 7).items():
        assert [(i, d, pytest.approx(s, abs=2e-10)) for i, (d, s) in enumerate(want, 1)] == sorted(got[q])
    few = retrieval.cosine_topk(_cells(spark, asked, "query_id"), _cells(spark, {i: docs[i] for i in range(3)}, "doc_id"), 7)
    assert few.groupBy("query_id").count().where("count <> 3").count() == 0


def test_knn_of_text_keys_and_empty_tables(spark):
    docs = {"b": {1: 1.0}, "a": {1: 2.0}, "c": {2: 1.0}}
    dvec, qvec = _cells(spark, docs, "doc_id", "string"), _cells(spark, {"q": {1: 3.0}}, "query_id", "string")
    assert [tuple(r) for r in retrieval.cosine_topk(qvec, dvec, 2).orderBy("rank").collect()] == [("q", 1, "a", 1.0), ("q", 2, "b", 1.0)]
    assert retrieval.cosine_topk(qvec.limit(0), dvec, 2).count() == 0 and retrieval.cosine_topk(qvec, dvec.limit(0), 2).count() == 0


def test_knn_plan_does_not_grow_with_the_queries(spark):
    rng = np.random.RandomState(5)
    dvec = _cells(spark, _vectors(rng, 20, 30, 4), "doc_id")
    plans = [retrieval.cosine_topk(_cells(spark, _vectors(rng, n, 30, 4), "query_id"), dvec, 3)._jdf.queryExecution().optimizedPlan().toString()
             for n in (2, 600)]
    assert plans[0].count("\n") == plans[1].count("\n")


def test_chi2_binarized_has_two_categories(spark):
    from pyspark.ml.linalg import Vectors
    from tessera.operators import textml
    df = spark.createDataFrame([(Vectors.dense([0.0, 1.5]), 0.0), (Vectors.dense([2.0, 0.7]), 1.0),
                                (Vectors.dense([3.0, 0.0]), 1.0)], ["features", "label"])
    vocab = spark.createDataFrame([(0, "a"), (1, "b")], "idx int, term string")
    raw = {r.term: r.dof for r in textml.chi2_table(df, vocab).collect()}
    binned = {r.term: r.dof for r in textml.chi2_table(df, vocab, binarize=True).collect()}
    assert raw == {"a": 2, "b": 2} and binned == {"a": 1, "b": 1}


def test_terms_are_counted_in_the_row(spark):
    """No task sorts or groups the cells of its documents; ids that repeat or are null still make one document each."""
    docs = spark.createDataFrame([(1, "b a b"), (1, "a c zz"), (2, "zz"), (None, "c"), (None, "c b"), (3, None)], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, idx int")
    terms = text.doc_terms(docs, vocab, totals=True)
    assert sorted(map(tuple, terms.collect()), key=str) == sorted(
        [(1, 0, 2, 5), (1, 1, 2, 5), (1, 2, 1, 5), (None, 1, 1, 3), (None, 2, 2, 3)], key=str)
    tf = text.term_freq(terms)
    key = lambda df: sorted((str(r.doc_id), r.idx, r.tf) for r in df.collect())        # noqa: E731
    assert key(tf) == key(text.term_freq(text.doc_terms(docs, vocab)))
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "keys=[doc_id#" in plan and ", idx#" not in "".join(x for x in plan.split("\n") if "keys=" in x)


def test_knn_writes_no_copies_of_the_vectors(spark, monkeypatch):
    """Shards meet parts as a product of two stored tables: none is copied for the other through an exchange."""
    monkeypatch.setattr(retrieval, "SHARD_DOCS", 4)
    monkeypatch.setattr(retrieval, "PART_QUERIES", 4)
    rng = np.random.RandomState(6)
    dvec, qvec = (_cells(spark, _vectors(rng, 40, 30, 4), key) for key in ("doc_id", "query_id"))
    plan = retrieval.cosine_topk(qvec, dvec, 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "CartesianProduct" in below and "Exchange" not in below


def _block(name, vectors):
    """Vectors as a stored shard or part: an Arrow stream of (key, idx array, weight array)."""
    cells = [sorted(v.items()) for v in vectors.values()]
    table = pa.table({name: pa.array(list(vectors)), "idx": pa.array([[w for w, _ in v] for v in cells], pa.list_(pa.int32())),
                      "weight": pa.array([[x for _, x in v] for v in cells], pa.list_(pa.float64()))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _texts(rng, n, words, low, high, signed=False):
    """Vectors with words of all frequencies, of two halves of the vocabulary that hardly mix."""
    out = {}
    for i in range(n):
        found = np.unique((words * rng.rand(rng.randint(low, high)) ** 3).astype(int))
        found = np.where(rng.rand(len(found)) < 0.95, found + words * (i % 2), found)
        out[i] = {int(w): float(rng.randint(1, 5) * (rng.choice([-1, 1]) if signed else 1)) for w in found}
    return out


def _searched(asked, docs, k, rows, size, most):
    """query -> [(doc, score)] from the worker's search, over shards of ``size`` documents."""
    ids = list(docs)
    shards = [_block("doc_id", {i: docs[i] for i in ids[low:low + size]}) for low in range(0, len(ids), size)]
    part = _block("query_id", asked)
    batches = (pa.RecordBatch.from_arrays([pa.array([x], pa.binary()), pa.array([7]), pa.array([part], pa.binary())],
                                          ["shard", "part", "block"]) for x in shards)
    got = {}
    for batch in retrieval._search(k, 10, 8, rows, most)(batches):
        for q, d, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "doc_id", "score"))):
            got.setdefault(q, []).append((d, s))
    return {q: sorted(found, key=lambda r: (-r[1], r[0])) for q, found in got.items()}


@pytest.mark.parametrize("signed", [False, True])
def test_search_keeps_exact_neighbours(signed):
    """Frequent and rare words, kinds of vectors, merges: neighbours of double precision, also where single precision
    cannot tell documents apart, ties by id, and documents without a shared word."""
    rng = np.random.RandomState(11)
    docs, asked = _texts(rng, 500, 300, 5, 60, signed), _texts(rng, 90, 300, 3, 40, signed)
    for i in range(500, 560):                        # copies, and copies that differ by a hair
        docs[i] = dict(docs[i - 480])
        if i % 2:
            docs[i][min(docs[i])] *= 1 + 1e-6 * (i % 7)
    docs[560], asked[90], asked[91] = {5: 0.0}, {6: 0.0}, {10_000: 1.0}
    asked[92] = {**{w: 1e-9 for w in range(3)}, 10_000: 1.0}      # shares next to nothing
    docs = {i: docs[i] for i in rng.permutation(561).tolist()}
    want = _neighbours(asked, docs, 10)
    for rows, size, most in ((2048, 1000, 1 << 20), (16, 40, 1 << 14), (5, 7, 1)):
        got = _searched(asked, docs, 10, rows, size, most)
        for q in asked:
            assert [(d, pytest.approx(s, abs=2e-10)) for d, s in want[q]] == got[q], (rows, q)


def test_search_multiplies_only_common_words(monkeypatch):
    """Documents are not laid out over all words of a block of queries: of 6,000 words a pair meets few."""
    rng = np.random.RandomState(12)
    docs, asked = _texts(rng, 400, 3000, 100, 300), _texts(rng, 200, 3000, 20, 100)
    cells, plain = [], np.matmul
    monkeypatch.setattr(np, "matmul", lambda a, b, **kw: cells.append(len(a) * b.size) or plain(a, b, **kw))
    assert sum(map(len, _searched(asked, docs, 10, 2048, 1000, 1 << 20).values())) == 2000
    used = len(set().union(*asked.values()) & set().union(*docs.values()))
    assert used > 2500 and 0 < sum(cells) < 0.2 * used * len(docs) * len(asked)
