"""The registered queries of the operators: contract columns over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from storepulse.llm import (
    ann, bpe, collocations, conversations, mixing, near_dedup, pii, quality_classifier,
    quality_rules, token_files, topk, toxicity, url_filter,
)
from storepulse.llm.common import table
from storepulse.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, with_ids=False,
    )


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as shards, read back."""
    model = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    path = scratch_path(spark, "token-shards")
    token_files.write_shards(
        table(spark, sf_dir, "documents"), model, public_tokenizers.PATTERN, path)
    return token_files.decoded(token_files.read_shards(spark, path), with_ids=False)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean(table(spark, sf_dir, "documents"), with_text=False)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = quality_classifier.described(table(spark, sf_dir, "documents"))
    model = quality_classifier.train(described, table(spark, sf_dir, "labels"))
    return quality_classifier.score(described, model)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(
        table(spark, sf_dir, "documents"), near_dedup.Settings(words=3, percent=85))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged)[0]


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_bpe": op2_bpe,
    "op3_neighbours": op3_neighbours,
    "op4_mixing": op4_mixing,
    "op5_token_files": op5_token_files,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filter": op8_url_filter,
    "op9_near_dedup": op9_near_dedup,
    "op10_pii": op10_pii,
    "op11_phrases": op11_phrases,
    "op12_topk": op12_topk,
    "op13_conversations": op13_conversations,
}
