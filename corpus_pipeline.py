"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, substring
dedup and packing over ``documents``.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` and returns
the columns of ``documents``, but for the last, which returns packed pieces.
The result of a stage is written as Parquet and read again as the next one's
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import lang_id, line_dedup, packing, simhash, substring_dedup
from tessera.llm.common import free_name
from tessera.llm.queries import END_ID, LINE_WINDOW, LINE_WORDS, PASSAGE_WORDS, SEQUENCE, vocabulary
from tessera.session import load, scratch_path


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a language that was learned; a null ``lang`` becomes the predicted one.

    Profiles come from the documents with a language.  Rejected: texts without
    a letter, and those whose score is below the limit that the scores of the
    labelled documents set for the predicted language.
    """
    profiles = lang_id.Profiles(lang_id.train_profiles(docs))
    limits = lang_id.score_limits(docs, profiles)
    names = docs.columns
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    named = lang_id.identify(docs, profiles, lang_name=lang, score_name=score)
    low = F.lit(0.0)
    for name, limit in sorted(limits.items()):
        low = F.when(F.col(lang) == name, limit).otherwise(low)
    kept = named.where((F.col(lang) != "und") & (F.col(score) >= low))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(*names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the runs of lines that occur earlier; a document that loses all its lines goes."""
    out = _measured(line_dedup.drop_repeated_runs(docs, window=LINE_WINDOW, long_words=LINE_WORDS))
    return out.where("trim(text) <> ''")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that occur earlier; a document that loses its whole text goes."""
    out = _measured(substring_dedup.drop_repeated_passages(docs, min_words=PASSAGE_WORDS))
    return out.where("trim(text) <> ''")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences along the curve."""
    pieces = packing.pack(docs, vocabulary(spark), length=SEQUENCE, end_id=END_ID)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [("language_id", identify_language), ("line_dedup", drop_repeated_lines),
          ("simhash_near_dedup", drop_near_duplicates), ("substring_dedup", drop_repeated_passages),
          ("packing", pack)]

# Tokenisation, rolling hashes and fingerprints are not expressible in SQL;
# tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
