"""Queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenwin.llm import alignment, decontaminate, lines, lm, mixing, neardup, oracle, prefixes, quality, tokencount, tokenfile, toxicity, vectors, warc
from tokenwin.llm.tables import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train_toxicity(docs, labels, usable=fold("doc_id", 4) != 2)
    scores = toxicity.score_toxicity(docs, model)
    return scores.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_file_index(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.score_texts(table(spark, sf_dir, "documents"), learn=fold("doc_id", 10) != 0)
    return scores.withColumn("held_out", fold("doc_id", 10) == 0)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    payload_bytes = F.coalesce(F.length("payload").cast("bigint"), F.col("payload_bytes"))
    return records.select(
        "page_id", payload_bytes.alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train_quality(docs, labels, usable=fold("doc_id", 5) != 0)
    scores = quality.score_quality(docs, model)
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.md5(F.encode("text", "utf-8")).alias("text_md5"))


def op11_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.conversation_turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefixes.prefix_tree(*prefixes.rebuild(turns, F.col("conv_id") - F.col("conv_id") % 20, head))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
