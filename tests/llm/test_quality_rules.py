import re
from collections import Counter

import pytest

from tessera.llm import quality_rules


def measures(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {p for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def test_against_brute_force(spark, docs, corpus):
    rows = corpus + [(100 + i, t, "en", "spam", 0) for i, t in enumerate(
        ["x y z " * 40, "a b\nc d\na b\na  b", "# $ % & | < > *", "a b c a b c", "é ü ß 日本", "a b c d e a b c d"])]
    frame = spark.createDataFrame(rows, docs.schema).withColumnRenamed("n_chars", "_words").withColumnRenamed("lang", "h")
    got = {}
    for r in quality_rules.host_verdicts(frame).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    failed, hosts = Counter(), Counter()
    for r in rows:
        m = measures(r[1])
        bad = m[0] < 50 or 100 * m[4] > 50 * m[0]
        hosts[r[3]] += 1
        failed[r[3]] += bad
        for g in got[r[0]]:
            assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == (*m, bad), r[0]
    rates = [failed[h] / hosts[h] for h in hosts]
    m = sum(rates) / len(rates)
    v = sum((x - m) ** 2 for x in rates) / len(rates)
    s = max(0.0, m * (1 - m) / v - 1) if v else 1.0
    for r in rows:
        rate = (failed[r[3]] + s * m) / (hosts[r[3]] + s)
        for g in got[r[0]]:
            assert g.host_rate == pytest.approx(rate, abs=1e-8)
            assert g.kept == (not g.base_failed and rate <= 0.5)


def test_one_host_and_empty(spark, docs, empty):
    assert quality_rules.host_verdicts(empty).count() == 0
    one = spark.createDataFrame([(1, "word " * 60, None, None, 1), (2, None, None, None, None)], docs.schema)
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.host_verdicts(one).collect()}
    assert got == {1: (True, False), 2: (True, False)}


def test_main_path_is_native(docs):
    plan = quality_rules.host_verdicts(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
