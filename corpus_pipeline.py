"""Corpus pipeline: each stage works on everything its predecessor kept.

Every stage takes and returns the columns of ``documents``; the last one returns token digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import bpe, decontaminate, langid, lines, neardup
from corpusloom.llm.columns import free_name
from corpusloom.llm.queries import WORD_BPE, bpe_digest, prepare
from corpusloom.session import scratch_path

# A text whose best language has less than this share of its words is no text of a known language.
MIN_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: texts without a letter, or of no language by far, go."""
    prepare(spark)
    crf = langid.train(docs, F.lit(True))
    lang, score = (free_name(docs.columns, name) for name in ("_lang", "_score"))
    named = langid.predict(docs, crf, lang, score)
    return named.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_SCORE)).drop(lang, score)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a line found in several stays only in the smallest of them.

    Null texts become empty; rows without doc_id keep their lines and count for none; repeated rows stay.
    """
    prepare(spark)
    kept = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest document, once; rows without doc_id stay."""
    prepare(spark)
    key = free_name(docs.columns, "_kept")
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(key)).distinct()
    one = docs.join(kept, F.col("doc_id").cast("long") == F.col(key), "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.where("doc_id is null"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of any benchmark item; null and empty texts have none and stay, repeated rows too."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; a null text counts as empty."""
    prepare(spark)
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(WORD_BPE))
    return bpe_digest(docs, vocabulary)


STAGES = [
    ("language ID", known_language),
    ("line dedup", unrepeated_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("BPE encoding and decoding", token_digests),
]

# The fitted language model and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{at}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
