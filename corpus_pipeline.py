"""A corpus from raw documents to token blocks, one stage after another.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read back as
the documents of the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenwin.llm import decontaminate, mixing, neardup, quality, tokenfile
from tokenwin.llm.tables import table
from tokenwin.shared import write_shared


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return neardup.keep_one(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Index of the token file of the corpus: ``(doc_id, start, n_tokens, ids_crc32)``."""
    return tokenfile.token_file_index(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("token_file", write_tokens),
]

# Learned weights and sampled signatures have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
