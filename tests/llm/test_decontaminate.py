import random
import re

import pytest

from tessera.llm import decontaminate as dc
from tests.llm.conftest import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """(n_words, n_hit, item strings, hit positions) by comparing every window of every item with every place."""
    w, hit, found = split(text), set(), set()
    for name, item in items:
        v = split(item)
        m = min(window, len(v))
        for s in range(len(v) - m + 1 if m else 0):
            for i in range(len(w) - m + 1):
                if w[i:i + m] == v[s:s + m]:
                    hit |= set(range(i, i + m))
                    if name is not None:
                        found.add(str(name))
    return len(w), len(hit), sorted(found), hit


@pytest.fixture(scope="module")
def items(corpus):
    rng = random.Random(2)
    long = words(rng, 40)
    out = [(i, words(rng, rng.randint(11, 30))) for i in range(12)]
    out += [(100, " ".join(corpus[2][1].split()[5:25])), (20, "Éa b-c, 3D"), (21, "alone"), (22, long), (23, long[:150]), (24, None),
            (25, ""), (26, "?!"), (None, "no id at all"), (3, words(rng, 12)), (9, "x y"), (9, "x y")]
    return out


@pytest.fixture(scope="module")
def texts(corpus, items):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in corpus]
    for i, (_, item) in enumerate(items):
        v = (item or "").split(" ")
        rows.append((200 + i, words(rng, 7) + " " + " ".join(v).upper().replace(" ", ",\n") + "! " + words(rng, 5)))
        rows.append((300 + i, words(rng, 3) + " " + " ".join(v[:9]) + " " + words(rng, 5) + " " + " ".join(v[1:11])))
        rows.append((400 + i, item))
    return rows + [(500, "ÉA B C 3d"), (501, "éa b c 3d"), (502, "alonex alone,ALONE"), (503, "no id at all"),
                   (504, "x y x y x"), (505, "x\x00y")]


@pytest.mark.parametrize("block", [8 << 20, 400])
def test_against_brute_force(spark, texts, items, block, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    monkeypatch.setattr(dc, "SEGMENT_WORDS", 4)
    monkeypatch.setattr(dc, "SLICE", 900)
    monkeypatch.setattr(dc, "PIECE", 50)
    bench = dc.Benchmark(spark.createDataFrame(items, "item_id long, text string"))
    assert (len(bench.blocks) > 3) == (block == 400)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in dc.find(docs, bench).collect())
    assert got == sorted(repr((i, *brute(t, items)[:3])) for i, t in texts)


def test_what_goes(spark, texts, items):
    bench = dc.Benchmark(spark.createDataFrame(items, "item_id long, text string"))
    rows = [(i, t, k) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "n_hit long, text string, spans long")       # names that the operator uses itself
    kept = dc.drop_documents(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(r.spans for r in kept.collect()) == [k for _, t, k in rows if not brute(t, items)[1]]
    cut = dc.drop_spans(docs, bench)
    assert cut.schema == docs.schema
    got = {r.spans: r.text for r in cut.collect()}
    for _, t, k in rows:
        hit = brute(t, items)[3]
        places = [m.span() for m in WORD.finditer((t or "").translate(LOWER))]
        drop = set()
        for p in hit:
            end = places[p + 1][0] if p + 1 in hit else places[p][1]
            drop |= set(range(places[p][0], end))
        assert got[k] == (t if t is None else "".join(c for j, c in enumerate(t) if j not in drop))


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(dc, "_hash", lambda words, at, size: at.astype("u8") * 0)
    block = dc.Block([("a", b"p q r"), ("b", b"q p r"), ("c", b"r r p")], 3)
    words = block.numbers(b"q p r r p")[0]
    assert sorted((int(p), block.names[items[starts[w]]]) for _, pos, win, starts, items in block.hits(words)
                  for p, w in zip(pos, win)) == [(0, "b"), (2, "c")]


def test_long_text_empty_tables_other_windows(spark, items, empty):
    item = items[0][1]
    text = ("lorem ipsum " * 300_000) + item + " dolor" * 300_000
    bench = dc.Benchmark(spark.createDataFrame(items, "item_id long, text string"))
    r = dc.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()
    assert (r.n_hit, r["items"], r.n_words) == (len(split(item)), ["0"], 900_000 + len(split(item)))
    assert [text.encode()[s.start:s.end] for s in r.spans] == [item.encode()]
    assert dc.find(empty, bench).count() == 0
    none = dc.Benchmark(spark.createDataFrame([], "item_id long, text string"))
    assert tuple(dc.find(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none).first()) == (1, 2, 0, [], [])
    pair = dc.Benchmark(spark.createDataFrame([(1, "a b c")], "item_id long, text string"), window=2)
    assert dc.find(spark.createDataFrame([(1, "x b c, a")], "doc_id long, text string"), pair).first().n_hit == 2
