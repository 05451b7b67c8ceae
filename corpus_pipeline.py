"""From raw documents to packed training sequences, in five stages.

Each stage's rows are written as Parquet to the shared folder and read again, so that a
lost executor repeats a part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listenlake.llm import exact_dedup, language_id, mixing, packing, simhash
from listenlake.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no language: null texts and texts without a letter."""
    return language_id.identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

# Tokenising and the learned language model have no SQL form; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
