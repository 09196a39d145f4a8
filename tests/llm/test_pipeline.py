import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from pyspark.sql import functions as F
from tessera.llm import substring_dedup
from tessera.session import load
from tests.llm import brute
from tests.llm.test_simhash import plain as fingerprint


def expected(rows):
    """Documents after each stage but the last, by plain code: id -> text.  The fixture's ids are unique here."""
    docs = {r[0]: r[1] for r in rows}
    profiles = brute.profiles([(r[1], r[2]) for r in rows])
    limits = {}
    for lang in profiles:       # one in a thousand of so few is the lowest
        scores = [s for r in rows if r[2] == lang for p, s in [brute.rank_order(r[1], profiles)] if p == lang]
        limits[lang] = 0.7 * min(scores, default=0)
    kept = {}
    for i, text in docs.items():
        lang, score = brute.rank_order(text, profiles)
        if lang != "und" and score >= limits[lang]:
            kept[i] = text
    yield kept
    lines = brute.line_dedup(list(kept.items()), 3)
    kept = {i: t for (i, _), t in lines.items() if t.strip()}
    yield kept
    keys = sorted((i, fingerprint(t)) for i, t in kept.items())
    comp = brute.components(keys, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    kept = {i: kept[i] for i, _ in set(comp.values())}
    yield kept
    out = {i: t for (i, _), (t, _) in brute.substring_dedup(list(kept.items()), 20, substring_dedup.GEAR).items()}
    yield {i: t for i, t in out.items() if t.strip()}


@pytest.fixture(scope="module")
def stages(spark, docs, corpus, tmp_path_factory):
    rows = [r for k, r in enumerate(corpus) if r[0] is not None and r not in corpus[:k]]
    frame = spark.createDataFrame(rows, docs.schema)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, frame, "").write.parquet(path)
        frame = spark.read.parquet(path)
        out.append(frame)
    return rows, out


def test_against_brute_force(docs, stages):
    rows, out = stages
    text = {}
    for want, frame in zip(expected(rows), out[:-1]):
        assert frame.columns == docs.columns
        got = frame.collect()
        assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
        text = want
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in text.items()}
    pieces = out[-1].collect()
    assert {p.doc_id: p.doc_tokens for p in pieces} == tokens
    assert sum(p.length for p in pieces) == sum(tokens.values())


def test_registered_and_runs(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert pieces.count() > 0 and "sequence_id" in pieces.columns


def test_language_stage(spark):
    """A language that no document is labelled with goes, short clean texts stay, names that clash do no harm."""
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    strange = ["Suomen kieli on uralilainen kieli, jota puhutaan pääasiassa Suomessa ja se kuuluu itämerensuomalaisiin kieliin",
               "Język polski należy do grupy języków zachodniosłowiańskich i jest używany głównie w Polsce",
               "Türkçe ya da Türk dili, batıda Balkanlar'dan başlayıp doğuda Hazar Denizi sahasına kadar konuşulan", "?!", None]
    clean = docs.where("n_chars between 20 and 60 and lang is not null").orderBy("doc_id").limit(8).collect()
    rows = [(-1 - i, t, None, "s", 0) for i, t in enumerate(strange)] + [(10 ** 6 + i, r.text, None, "s", 0) for i, r in enumerate(clean)]
    frame = docs.union(spark.createDataFrame(rows, docs.schema)).withColumn("Score", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    out = corpus_pipeline.identify_language(spark, frame, "")
    assert out.columns == frame.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert set(kept) == {r.doc_id for r in docs.collect()} | {10 ** 6 + i for i in range(len(clean))}
    assert all(kept[10 ** 6 + i].lang and kept[10 ** 6 + i].lang_pred == "x" for i in range(len(clean)))


def test_empty_table(spark, docs, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
