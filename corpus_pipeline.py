"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before it
kept, and returns the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from tidemark.llm.io import cut, table
from tidemark.session import ship

#: A document stays if a language is recognised with at least this probability.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages that ``lang`` teaches; ``und`` and doubtful ones go."""
    ship(spark)
    known = language_id.predict(docs, language_id.train(docs), lang_name="__lang", score_name="__score")
    return known.where((F.col("__lang") != "und") & (F.col("__score") >= LEAST_LANGUAGE_SCORE)).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines out of the texts; no document goes."""
    ship(spark)
    kept = line_dedup.remove_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that five-word shingles link at 0.8."""
    ship(spark)
    return near_dedup.keep_one(docs, k=5, percent=80).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a test item of ``benchmark``, exact or edited."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [("language ID", language), ("line dedup", lines), ("near-duplicates", near), ("decontamination", benchmark), ("packing", pack)]

#: The stages train a model, compare sets by signatures and tokenise: SQL cannot say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
