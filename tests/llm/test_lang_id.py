import zlib
from collections import Counter

import numpy as np

import pytest

from tessera.llm import lang_id
from tessera.session import load
from tests.llm import brute
from tests.llm.brute import grams


def test_gram_counts(monkeypatch):
    text = "Hello, wörld 42 hello! a"
    for piece in (1 << 20, 5):
        monkeypatch.setattr(lang_id, "PIECE", piece)
        keys, counts = lang_id.gram_counts(lang_id.letters(text))
        assert sorted(counts.tolist()) == sorted(grams(text).values())
        assert len(set(keys.tolist())) == len(keys)


def test_nothing_to_read(spark, docs, empty):
    profiles = lang_id.Profiles(lang_id.train_profiles(docs))
    rows = [(i, t) for i, t in enumerate([None, "", " \n", "12 ?!", "hello there"])]
    got = lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), profiles).collect()
    assert [(r.lang_pred, r.score) for r in got[:4]] == [("und", 0.0)] * 4 and got[4].lang_pred in ("en", "fr")
    assert lang_id.identify(empty, profiles).count() == 0
    none = lang_id.Profiles(lang_id.train_profiles(empty))
    assert lang_id.identify(docs, none).where("lang_pred <> 'und' or score <> 0").count() == 0


def test_profiles_against_brute_force(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, "the dog", "en"), (4, "x", None),
            (5, None, "en")]
    table = lang_id.train_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), size=10).collect()
    for lang in ("en", "de"):
        want = sum((grams(r[1]) for r in rows if r[2] == lang and r[1]), Counter())
        got = sorted((r["rank"], r["gram"]) for r in table if r["lang"] == lang)
        assert [r for r, _ in got] == list(range(10))
        keys, counts = lang_id.gram_counts(np.concatenate([lang_id.letters(r[1]) for r in rows if r[2] == lang and r[1]]))
        assert sorted(counts.tolist()) == sorted(want.values())
        assert [g for _, g in got] == lang_id.top_grams(keys, counts, 10).tolist()


def test_held_out_fold(docs):
    for r in docs.select("doc_id", lang_id.held_out("doc_id").alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    held = lang_id.held_out("doc_id")
    profiles = lang_id.Profiles(lang_id.train_profiles(docs.where(~held)))
    rows = lang_id.identify(docs.where(held), profiles).select("lang", "lang_pred", "score").collect()
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95


def test_prediction_against_brute_force(spark, corpus):
    """Out-of-place distances of the given documents and of odd texts, by plain code."""
    docs = load(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    rows = [(r.text, r.lang) for r in docs.collect()]
    odd = [None, "", "?!", "a", "Straße ÉTÉ İx", "the", "ab ab ab", "日本語 テスト", "x" * 5000] + [r[1] for r in corpus]
    profiles = lang_id.Profiles(lang_id.train_profiles(docs))
    want = brute.profiles(rows)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([t for t, _ in rows] + odd)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(frame, profiles).collect()}
    for i, t in enumerate([t for t, _ in rows] + odd):
        lang, score = brute.rank_order(t, want)
        assert got[i] == (lang, pytest.approx(score, abs=1e-12)), t


def test_ties_and_clashing_names(spark):
    rows = [(1, "abc", "zz"), (2, "abc", "aa"), (3, "abc", "mm")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = lang_id.Profiles(lang_id.train_profiles(docs))
    assert {r.lang_pred for r in lang_id.identify(docs, profiles).collect()} == {"aa"}
    with pytest.raises(ValueError, match="lang"):
        lang_id.identify(docs, profiles, lang_name="LANG")
    assert lang_id.score_limits(docs, profiles) == {"aa": pytest.approx(0.7)}


def test_a_column_that_is_no_language(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "abc", f"x{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="3 languages"):
        lang_id.Profiles(lang_id.train_profiles(docs))


def test_a_long_text(spark):
    rows = [(1, "the cat and the dog " * 500_000, "en"), (2, "der hund und die katze", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = lang_id.Profiles(lang_id.train_profiles(docs))
    assert [r.lang_pred for r in lang_id.identify(docs, profiles).orderBy("doc_id").collect()] == ["en", "de"]
