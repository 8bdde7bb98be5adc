"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; ``run``
writes each result to the shared folder and reads it back for the next. What a stage wrote for itself goes
when its result is written.

All stages but the last return the columns of ``docs`` as they are, whatever further columns these have and
whatever they are called. Cases, in this order: toxicity keeps null and empty texts (nothing in them is
toxic), and judges rows one by one, also those that share an id; language ID drops texts without a letter,
and all texts if no document is labelled with a language; near-dedup keeps one row of each group, the one of
least id, one of rows that are alike in id and set of words, and all rows without an id; decontamination keeps all
documents if there is no benchmark; packing cuts texts of more than one sequence. Very long texts are taken
whole throughout. An empty table of documents gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ravelin.llm import decontamination, language_id, near_dedup, packing, toxicity
from ravelin.llm.common import discard, materialize, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8."""
    return near_dedup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Tokenizers, learned scores and alignments are beyond SQL; ``tests/llm`` holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            ahead = keep(materialize(stage(spark, docs, sf_dir), f"stage-{name}"))
        discard(docs)
        docs = ahead
    return docs
