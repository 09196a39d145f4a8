import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tessera.llm import perfect_hash, queries, token_alignment as ta

PATHS = [public_tokenizers.path(f) for f in queries.ALIGNED]
LIB_A = Tokenizer.from_file(PATHS[0])
LIB_A.encode_special_tokens = True
LIB_B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
CODEC = ta.Codec(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())
ODD = ["", " ", "  two  spaces ", "a\nb\tc\x00d", "<|endoftext|> <s> </s> <unk> <0x41>", "▁x ▁", "école 日本語 👩‍👩‍👧", "a" * 700,
       "ﬁ ½ Å é", "don't I'LL 'sx", "x . , y", "1 2 34567", "﻿q", "tail ", " lead", "a  b", "é è", "<P>  <M>"]


def byte_values():
    """A's printable stand-ins, by the published rule."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {**{chr(b): b for b in keep}, **{chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}}


BYTES = byte_values()


def tokens(text):
    """``(ids, spellings)`` by both libraries, nothing where they do not spell blank + text."""
    if not text:
        return [], [], [], []
    a, b = LIB_A.encode(" " + text, add_special_tokens=False).ids, LIB_B.encode(text)
    ta_ = [bytes(BYTES[c] for c in LIB_A.id_to_token(i)) for i in a]
    tb = [bytes([int(p[3:5], 16)]) if LIB_B.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [LIB_B.id_to_piece(i)]]
    if not b"".join(ta_) == b"".join(tb) == (" " + text).encode():
        return [], [], [], []
    return a, ta_, b, tb


def ranges(spelled):
    ends = np.cumsum([len(s) for s in spelled]).tolist()
    return list(zip([0, *ends], ends))


def brute(texts):
    """The contract's columns for every text, links by comparing all ranges of a text."""
    coded = [tokens(t) for t in texts]
    links = []
    for a, sa, b, sb in coded:
        ra, rb = ranges(sa), ranges(sb)
        links.append([(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ra[i][0], rb[j][0]) < min(ra[i][1], rb[j][1])])
    count = Counter(x for ls in links for x in ls)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (a, sa, b, sb), ls in zip(coded, links):
        shared = sorted({e for _, e in ranges(sa)} & {e for _, e in ranges(sb)})
        groups = [",".join(str(i) for i, (s, e) in zip(a, ranges(sa)) if lo <= s and e <= hi) + "|" +
                  ",".join(str(i) for i, (s, e) in zip(b, ranges(sb)) if lo <= s and e <= hi) for lo, hi in zip([0, *shared], shared)]
        out.append((len(a), len(b), len(groups), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), ";".join(groups)))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" ab.,'1<"), max_size=30), max_size=5))
def test_encoding(texts):
    for text, a, b in zip(texts, *CODEC.encode(texts)):
        want = tokens(text)
        assert np.frombuffer(a, CODEC.dtype).tolist() == want[0] and np.frombuffer(b, CODEC.dtype).tolist() == want[2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdehinorstuwxyzABTW'.,\n-019!") , min_size=1, max_size=24), max_size=12))
def test_plain_words(words):
    """Plain words go through another library than the rest: the ids are the same."""
    assert CODEC.ranks is not None
    text = " ".join(words)
    (a,), (b,) = CODEC.encode([text])
    assert (np.frombuffer(a, CODEC.dtype).tolist(), np.frombuffer(b, CODEC.dtype).tolist()) == tokens(text)[::2]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2 ** 62), max_size=400), st.integers(1, 7))
def test_perfect_hash(keys, shards):
    keys = np.array(sorted(keys), np.int64)
    parts = [perfect_hash.build(keys[perfect_hash.bucket(keys) % shards == s]) for s in range(shards)]
    assert sorted(perfect_hash.Hash(parts, 0, shards).index(keys)) == list(range(len(keys)))
    half = perfect_hash.Hash(parts[:1], 0, shards).index(keys)
    assert sorted(half[half >= 0]) == list(range((perfect_hash.bucket(keys) % shards == 0).sum()))


@pytest.fixture(scope="module")
def rows(corpus):
    rows = [(r[0], r[1]) for r in corpus if len(r[1] or "") < 3000]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def files(spark):
    return ta.Vocabularies(spark, *PATHS)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, rows, files, small, monkeypatch):
    if small:           # many shards, salts, tree levels, broadcast blocks, slices and early hand-ons
        for name, value in (("SLICE", 500), ("TEXT_SLICE", 900), ("HELD_PAIRS", 300), ("SHARD_PAIRS", 100), ("GROUP_ROWS", 10), ("FAN", 2),
                            ("BLOCK_SHARDS", 3), ("GROUP_CHARS", 40)):
            monkeypatch.setattr(ta, name, value)
    got = ta.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), files).collect()
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]))]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def test_pairs_without_a_count_are_an_error():
    block = ta._Block([{k: b"" for k in ("sizes", "words", "keys", "counts")}], 0, 1)
    out = np.zeros(2, np.int64)
    block.add(np.array([3, 4]), out)
    assert out.tolist() == [0, 0]
    sizes, words, keys = ta._function(np.array([7, 9], np.int64))
    block = ta._Block([{"sizes": sizes.tobytes(), "words": words.tobytes(), "keys": keys.tobytes(),
                        "counts": (keys * 10).tobytes()}], 0, 1)
    out = np.zeros(40, np.int64)
    block.add(np.arange(40), out)
    assert {i: n for i, n in enumerate(out.tolist()) if n} == {7: 70, 9: 90}        # others are told apart by their key


def test_empty_and_clashing_names(spark, files, empty):
    assert ta.align(empty, files).count() == 0
    one = spark.createDataFrame([("x", "a b", 3, 4), ("y", None, 1, 2)], "a string, text string, n_b int, pair int")
    got = {r[0]: tuple(r)[1:] for r in ta.align(one, files, id_col="a").collect()}
    assert got == {"x": brute(["a b"])[0], "y": (0, 0, 0, 0, 0, 0, "")}


def test_a_long_text(spark, files):
    text = "Lorem ipsum, dolor sit. " * 60_000
    r = ta.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), files).first()
    a, _, b, _ = tokens(text)
    assert (r.n_a, r.n_b) == (len(a), len(b))
    assert ",".join(g.split("|")[0] for g in r.groups.split(";")) == ",".join(map(str, a))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 4000]
    every = queries.op13_token_alignment(spark, d)
    assert every.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.doc_id: r for r in every.collect()}
    for (i, _), want in zip(docs, brute([t for _, t in docs])):
        assert tuple(got[i])[1:5] == want[:4]
        assert got[i].groups_sha256 == (hashlib.sha256(want[6].encode()).hexdigest() if want[0] else "")
