"""Registered queries of this sub-package and their DuckDB SQL.

Each query applies one operator, with production parameters, to the whole of
its table and derives the digest columns from the operator's own results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (decontaminate, fill_in_middle, html_extract, lang_id, line_dedup, packing, quality_rules,
                         simhash, substring_dedup, token_alignment, topk, url_filters, word_bpe)
from tessera.session import load

VOCABULARY = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"
LINE_WINDOW = 3             # lines a repeated run has at least
LINE_WORDS = 50             # ... or words it has more than
PASSAGE_WORDS = 20          # words a repeated passage has at least, whole chunks only
END_ID, SEQUENCE = 2, 4096


def vocabulary(spark: SparkSession) -> word_bpe.Vocabulary:
    return word_bpe.Vocabulary(spark, public_tokenizers.path(VOCABULARY))


def op1_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_runs(docs, window=LINE_WINDOW, long_words=LINE_WORDS, removed_col="removed_lines")
    return out.withColumn("n_removed", F.size("removed_lines").cast("long"))


def op2_word_bpe(spark: SparkSession, d: str) -> DataFrame:
    coded = word_bpe.round_trip(load(spark, d, "documents"), vocabulary(spark))
    return coded.select("doc_id", "n_tokens", word_bpe.digest(F.col("ids")).alias("ids_sha256"),
                        word_bpe.digest(F.col("decoded")).alias("decoded_sha256"))


def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.host_verdicts(load(spark, d, "documents"))


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, d, "documents"), shingle=4, max_bits=4)


def op5_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select("doc_id", "text")
    out = substring_dedup.drop_repeated_passages(docs, min_words=PASSAGE_WORDS, spans_col="removed_spans")
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.withColumn("n_removed_bytes", removed)


def op6_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = load(spark, d, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5).withColumnRenamed("id", "vec_id")


def op7_url_filters(spark: SparkSession, d: str) -> DataFrame:
    pages = load(spark, d, "pages").select("page_id", "url")
    return url_filters.filter_urls(url_filters.captures_of(pages), url_filters.entries_of(pages), id_cols=["page_id"])


def op8_html_extract(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(load(spark, d, "pages"), url_filters.host_of(F.col("url")))


def op9_lang_id(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select("doc_id", "text", "lang")
    held = lang_id.held_out("doc_id")
    profiles = lang_id.Profiles(lang_id.train_profiles(docs.where(~held)))
    return lang_id.identify(docs.select("doc_id", held.alias("held_out"), "text"), profiles).select(
        "doc_id", "held_out", "lang_pred", "score")


def op10_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, vocabulary(spark), length=SEQUENCE, end_id=END_ID)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    out = fill_in_middle.transform(load(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_in_middle.restore(), 256).alias("restored_sha256"))


def op12_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    benchmark = decontaminate.Benchmark(load(spark, d, "benchmark").select("item_id", "text"))
    out = decontaminate.find(load(spark, d, "documents").select("doc_id", "text"), benchmark)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op13_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    files = token_alignment.Vocabularies(spark, *map(public_tokenizers.path, ALIGNED))
    out = token_alignment.align(load(spark, d, "documents").select("doc_id", "text"), files)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return out.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_word_bpe, op3_quality_rules, op4_simhash, op5_substring_dedup, op6_topk, op7_url_filters,
        op8_html_extract, op9_lang_id, op10_packing, op11_fill_in_middle, op12_decontaminate,
        op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": quality_rules.ORACLE_SQL, "op6_topk": topk.ORACLE_SQL,
            "op7_url_filters": url_filters.ORACLE_SQL, "op11_fill_in_middle": fill_in_middle.ORACLE_SQL,
            "op12_decontaminate": decontaminate.ORACLE_SQL}
