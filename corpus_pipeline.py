"""From raw documents to encoded training text: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, in their own columns; the
last returns doc_id, n_pieces and the pieces of each text. A stage that changes a text also sets
n_chars, where the documents have that column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import decontaminate, language, near_dedup, pieces, substrings
from palimpsest.llm.registry import ship_package, table
from palimpsest.scratch import materialise
from palimpsest.session import apply_runtime_settings


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a learned language is found; those without any letter go."""
    return language.keep_identified(docs, language.fit(language.training_part(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, that with the smallest doc_id."""
    return near_dedup.keep_one_of_each(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without spans that start earlier; documents of which nothing is left go."""
    cleaned = substrings.remove_repeats(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.where(F.length("text") > 0)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces and the sampled pieces of every document."""
    return pieces.encode(docs).select("doc_id", F.size("pieces").alias("n_pieces"), "pieces")


def _stage(function):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(apply_runtime_settings(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _stage(identify_language)),
    ("near_duplicates", _stage(drop_near_duplicates)),
    ("repeated_spans", _stage(drop_repeated_spans)),
    ("decontamination", _stage(drop_contaminated)),
    ("pieces", _stage(encode_texts)),
]

# Fitted languages and sampled pieces cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
