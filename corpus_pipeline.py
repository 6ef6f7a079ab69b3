"""From raw documents to packed token sequences, in stages that each read what the last one kept.

Every stage is one operator of ``tillwise.llm`` over the whole table.  The first three
drop rows, also where ids repeat or are NULL, and keep the columns; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import exact_dedup, near_dup, packing, quality
from tillwise.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is one half or more."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, A-Z lower-cased, the one with the smallest id."""
    return exact_dedup.drop_exact(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a similarity of 0.8 on five-word shingles, the one with the smallest id."""
    return near_dup.drop_near(docs, size=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, each document next to its lexical neighbours."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), remembered=250_000)


STAGES = [("quality", keep_good), ("exact_dedup", keep_distinct), ("near_dedup", keep_one_of_near), ("packing", pack)]

#: Token ids can't be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
