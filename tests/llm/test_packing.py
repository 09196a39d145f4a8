import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import packing

LIB = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert np.abs(np.diff(cells[keys.argsort()], axis=0)).sum(1).max() == 1


def test_like_documents_lie_together():
    rng = np.random.default_rng(0)
    topics = [rng.integers(0, 40000, 50) for _ in range(2)]
    lists = [rng.choice(topics[i % 2], 400) for i in range(60)]
    order = packing.curve_keys(lists).argsort()
    assert sum(int(a % 2 != b % 2) for a, b in zip(order, order[1:])) < 15


def check(pieces, rows, length):
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append(LIB.encode(r[1] or "", add_special_tokens=False).ids + [2])
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert by.keys() == ids.keys()
    for doc, lists in ids.items():
        lists = sorted(lists)
        got = sorted(by[doc], key=lambda p: (p.sequence_id, p.offset))
        found, part = [], []
        for p in got:
            assert p.start == len(part) and p.length * 4 == len(p.ids)
            part += np.frombuffer(p.ids, "<u4").tolist()
            if len(part) == p.doc_tokens:
                found.append(part)
                part = []
        assert not part and sorted(found) == lists
    fill = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0) and p.length > 0
        fill[p.sequence_id] = p.offset + p.length
    assert sorted(fill) == list(range(len(fill)))
    assert all(fill[s] == length for s in range(len(fill) - 1)) and 0 < fill[len(fill) - 1] <= length


def test_pieces(docs, corpus, vocabulary):
    clash = docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "key")
    for length in (64, 4096):
        check(packing.pack(clash, vocabulary, length=length).collect(), corpus, length)


def test_null_ids_and_empty_table(spark, empty, vocabulary):
    assert packing.pack(empty, vocabulary).count() == 0
    got = packing.pack(spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string"), vocabulary).collect()
    assert sorted(p.doc_tokens for p in got) == [1, 3] and {p.doc_id for p in got} == {None}


def test_many_copies_of_one_row(spark, vocabulary, monkeypatch):
    """100,000 copies of a row: dealt to many tasks by ranges, every piece in its place, small batches."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(packing, "HELD_TOKENS", 5000)
    n = 100_000
    docs = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a copied row").alias("text")).union(
        spark.range(500).select((F.col("id") + 10).alias("doc_id"), F.concat(F.lit("other "), F.col("id").cast("string")).alias("text")))
    pieces = packing.pack(docs, vocabulary, length=256).withColumn("task", F.spark_partition_id()).cache()
    total, first, last, ids = pieces.agg(F.sum("length"), F.min("sequence_id"), F.max("sequence_id"), F.count_distinct("doc_id")).first()
    assert (first, last, ids) == (0, (total - 1) // 256, 501)
    assert pieces.where("doc_id = 7").agg(F.sum("length")).first()[0] == n * pieces.where("doc_id = 7").first().doc_tokens
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.sum(F.col("offset") * 2 + F.col("length")).alias("m"))
    assert sums.where(f"n <> 256 and sequence_id < {last}").count() == 0
    # gapless: the pieces' places, each from its offset on, add up to those of 0 .. n
    placed = pieces.select("sequence_id", F.explode(F.sequence(F.col("offset"), F.col("offset") + F.col("length") - 1)).alias("p"))
    assert placed.groupBy("sequence_id").agg(F.count("p").alias("n"), F.count_distinct("p").alias("m")).where("n <> m").count() == 0
    tasks = [r.n for r in pieces.groupBy("task").agg(F.count("*").alias("n")).collect()]
    assert len(tasks) >= 6 and max(tasks) < 0.5 * sum(tasks)
