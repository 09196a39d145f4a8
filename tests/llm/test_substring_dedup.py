import random

import numpy as np
import pytest

from tessera.llm import substring_dedup
from tests.llm import brute
from tests.llm.brute import order_key
from tests.llm.conftest import words


def plain(rows, min_words):
    return brute.substring_dedup(rows, min_words, substring_dedup.GEAR)


@pytest.mark.parametrize("min_words", [1, 20])
def test_against_brute_force(docs, corpus, min_words):
    want = plain(corpus, min_words)
    clash = docs.withColumnRenamed("lang", "digest").withColumnRenamed("source", "hits").withColumnRenamed("n_chars", "H")
    out = substring_dedup.drop_repeated_passages(clash, min_words=min_words, spans_col="spans")
    assert out.columns == [*clash.columns, "spans"]
    got = sorted((order_key(r.doc_id), r.text or "", [tuple(s) for s in r.spans]) for r in out.collect())
    assert got == sorted((order_key(r[0]), want[order_key(r[0]), r[1]][0] or "", want[order_key(r[0]), r[1]][1])
                         for r in corpus)


def test_empty(empty):
    assert substring_dedup.drop_repeated_passages(empty).count() == 0


def test_chunks_cover_the_text():
    rng = random.Random(1)
    for text in ["", " ", "one", "a b", words(rng, 400), "an " * 200, "  x\n\ny\t z ", "é ü " * 30, None]:
        start, end, n, digest = substring_dedup.chunks(text)
        raw = (text or "").encode()
        assert b" ".join(raw[a:b] for a, b in zip(start, end)).split() == raw.split()
        assert n.sum() == len(raw.split()) == sum(len(raw[a:b].split()) for a, b in zip(start, end))
        assert len(n) == 0 or n.max() <= substring_dedup.FORCED_WORDS


def test_insertions_shift_nothing():
    rng = random.Random(2)
    found = []
    for _ in range(200):
        passage = words(rng, 51)
        a = substring_dedup.chunks(words(rng, rng.randint(0, 9)) + " " + passage + "\n" + words(rng, 7))
        b = substring_dedup.chunks(words(rng, rng.randint(0, 9)) + "\n\n" + passage.replace(" ", "  ", 1) + " " + words(rng, 3))
        both = set(a[3].tolist()) & set(b[3].tolist())
        found.append(sum(int(n) for n, d in zip(a[2], a[3].tolist()) if d in both))
    assert min(found) >= 20 and np.mean(found) > 38


def test_separators():
    text = "aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo pp qq rr ss tt uu vv ww xx yy zz"
    start, end, _, _ = substring_dedup.chunks(text)
    last = len(start) - 1
    assert substring_dedup.without_chunks(text, [0], 1)[0] == text[start[1]:]
    assert substring_dedup.without_chunks(text, [last], 1)[0] == text[:start[last]].rstrip()
    assert substring_dedup.without_chunks(text, list(range(last + 1)), 1)[0] == ""
    assert substring_dedup.without_chunks(text, [1], 1)[0] == text[:start[1]] + text[start[2]:]
    assert substring_dedup.without_chunks(text, [1], 99) == (text, [])


def test_chunks_against_plain_code():
    rng = random.Random(9)
    texts = ["", " ", "one", "a b", "an " * 200, "  x\n\ny\t z ", "é ü " * 30, "x" * 100] + [
        "".join(rng.choice(["  ", "\n", " "]) + w for w in words(rng, rng.randint(1, 150)).split()) for _ in range(60)]
    for text in texts:
        start, end, n, digest = substring_dedup.chunks(text)
        want = brute.chunks(text, substring_dedup.GEAR)
        assert [(a, b, k) for a, b, k in zip(start.tolist(), end.tolist(), n.tolist())] == [(a, b, len(w)) for a, b, w in want]
        assert len(set(digest.tolist())) == len({tuple(w) for _, _, w in want})
