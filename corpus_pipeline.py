"""From raw documents to packed training sequences.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame over everything its predecessor kept.  A stage's
result is written to the shared folder and read again before the next one starts, so a lost executor repeats
at most the stage at hand.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordersight.llm import decontam, langid, near_text, pack, toxicity
from ordersight.llm.common import read, stage
from ordersight.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores under 0.5."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: letters, and a mean posterior of at least 0.3 for the best label."""
    return langid.drop_unidentified(docs, langid.fit(docs), least=0.3)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    return near_text.drop_near_duplicates(docs)


def off_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens along the Hilbert curve."""
    return pack.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", off_benchmark),
    ("packing", packed),
]

#: Learned models and Viterbi paths have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
