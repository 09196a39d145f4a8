import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tessera.llm import fill_in_middle, queries

ODD = ["", "a", "é", "ab cd\n\nef", "<P>x", "a<S", "<M", "x<M>y", "日本 語abc 👩‍👩z\x00\x85", " \t", "<P", "aé<S" * 9, "S><P"]


def plain(doc_id, text):
    """The contract's row, by plain code."""
    text = text or ""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(parts)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (parts[:low], parts[low:high], parts[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=20), max_size=6))
def test_units(texts):
    for offset in range(min(2, len(texts) + 1)):
        got = fill_in_middle.units(pa.array(texts, pa.string()).slice(offset)).to_pylist()
        assert got == [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts[offset:]]


@pytest.fixture(scope="module")
def rows(corpus):
    rows = [(r[0], r[1]) for r in corpus]
    return rows + [(1000 + 31 * i + k, t) for i, t in enumerate(ODD) for k in range(12)]


def test_against_plain_code(spark, rows, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "SLICE", 700)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = fill_in_middle.transform(frame).withColumn("restored", fill_in_middle.restore())
    got = sorted(map(repr, (tuple(r) for r in out.collect())))
    assert got == sorted(repr((i, *plain(i, t), t or "")) for i, t in rows)
    assert {plain(i, t)[1] for i, t in rows} == {"plain", "psm", "spm"}


def test_a_very_long_text(spark):
    text = "lorem Ipsum\n, é " * 700_000           # 11 MB
    r = fill_in_middle.transform(spark.createDataFrame([(4, text)], "doc_id long, text string")).withColumn(
        "restored", fill_in_middle.restore()).first()
    assert tuple(r)[1:6] == plain(4, text) and r.restored == text


def test_clashing_names_and_empty(spark, empty):
    frame = spark.createDataFrame([("k", "a b", 1, 2)], "id string, text string, n int, output int")
    r = fill_in_middle.transform(frame, id_col="id").first()
    assert r.id == "k" and r.output == plain("k", "a b")[4]
    assert fill_in_middle.transform(empty).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op11_fill_in_middle(spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, pre, mid, out = plain(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, pre, mid, sha(out), sha(docs[r.doc_id] or ""))


def test_any_split_restores(spark):
    """Pieces that end in parts of a marker."""
    ends = ["", "<", "<S", "<P", "<M", "S>", "P>", "<<S", "x"]
    rows = [(i * 81 + j * 9 + k, p + "|" + m + "|" + s) for i, p in enumerate(ends) for j, m in enumerate(ends)
            for k, s in enumerate(ends)]
    out = fill_in_middle.transform(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.t for r in out.select("doc_id", fill_in_middle.restore().alias("t")).collect()}
    assert got == dict(rows)
