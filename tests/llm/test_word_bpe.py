import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tessera.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
OWN = word_bpe.WordBpe(open(PATH, encoding="utf-8").read())
ODD = ["", "  ", "a\x1cb c\x1d", "<|endoftext|>hi <|startoftext|><|endoftext|>", "İSTANBUL ΣΑΣ ς", "a" * 1000, "ab" * 700,
       "école it's I'LL we're '' 'sx", "123 4５6 ²", "\x85q\xa0r", "日本語 テスト 👩‍👩‍👧 x", "<|EndOfText|>", "\x00\x01a", "né"]


def same(text):
    ids = LIB.encode(text, add_special_tokens=False).ids
    return OWN.encode(text).tolist() == ids and OWN.decode(ids) == LIB.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40))
def test_any_text(text):
    assert same(text)


def test_scan_and_heap_agree(monkeypatch):
    words = ["internationalization", "aaaaaaaaaaaaa", "x", "dedededede"]
    scan = OWN.merge(words)
    monkeypatch.setattr(word_bpe, "LONG_WORD", 0)
    assert OWN.merge(words) == scan


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHE_ENTRIES", 5)
    texts = [f"word{i} other{i} a" for i in range(30)]
    own = word_bpe.WordBpe(open(PATH, encoding="utf-8").read())
    for t in texts:
        assert own.encode(t).tolist() == LIB.encode(t, add_special_tokens=False).ids
        assert len(own._cache) <= 5 + 3


def test_documents(spark, docs, corpus, empty, vocabulary):
    got = sorted((r.doc_id or -1, r.n_tokens, r.i, r.t) for r in word_bpe.round_trip(docs, vocabulary).select(
        "doc_id", "n_tokens", word_bpe.digest("ids").alias("i"), word_bpe.digest("decoded").alias("t")).collect())
    want = []
    for r in corpus:
        ids = LIB.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0] or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert word_bpe.round_trip(empty, vocabulary).count() == 0


def test_encode_then_decode(docs, corpus, vocabulary):
    coded = word_bpe.encode(docs, vocabulary)
    got = sorted((r.doc_id or -1, r.text) for r in word_bpe.decode(coded, vocabulary).collect())
    assert got == sorted((r[0] or -1, LIB.decode(LIB.encode(r[1] or "", add_special_tokens=False).ids,
                                                 skip_special_tokens=False)) for r in corpus)


def test_held_words_are_not_merged_again(monkeypatch):
    """A held word is not merged again with marks behind it, nor after the cache has turned over."""
    monkeypatch.setattr(word_bpe, "CACHE_ENTRIES", 6)
    own = word_bpe.WordBpe(open(PATH, encoding="utf-8").read())
    merged, merge = [], own.merge
    monkeypatch.setattr(own, "merge", lambda pieces: merged.extend(pieces) or merge(pieces))
    for text in ["kept été", "kept, été%%% other", *(f"kept été {c}x" for c in "abcdefghijkl")]:
        assert own.encode(text).tolist() == LIB.encode(text, add_special_tokens=False).ids
    assert merged.count("kept") == merged.count("été") == 1


@pytest.mark.parametrize("text", ["École, naïve!! word%%% été*** x'. y.' z's_ don't.", "ªº, ǅ; ʼn! ßß?'s 'll' a1, 1. é'",
                                  "_a_ (b) [c] \\d\\ `e` ~f~ <|g|> h|", "m'm, 're're ''' n'll'll"])
def test_marks_behind_words(text):
    assert same(text)
