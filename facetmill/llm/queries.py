"""One query per operator: the operator over its whole table, as the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversations, html, jaccard, language, mixing, negatives, pii, quality, simhash, sql, substrings, topk, urls

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    return urls.digest(_table(spark, sf_dir, "pages"))


def op2_mixing(spark, sf_dir):
    return mixing.digest(_table(spark, sf_dir, "documents"))


def op3_topk(spark, sf_dir):
    return topk.digest(_table(spark, sf_dir, "embeddings"))


def op4_html(spark, sf_dir):
    return html.digest(_table(spark, sf_dir, "pages"))


def op5_bpe(spark, sf_dir):
    return bpe.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_pii(spark, sf_dir):
    return pii.digest(_table(spark, sf_dir, "documents"))


def op7_substrings(spark, sf_dir):
    return substrings.digest(_table(spark, sf_dir, "documents"))


def op8_jaccard(spark, sf_dir):
    return jaccard.digest(_table(spark, sf_dir, "documents"))


def op9_language(spark, sf_dir):
    return language.digest(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark, sf_dir):
    return quality.digest(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    return negatives.digest(_table(spark, sf_dir, "embeddings"))


def op12_conversations(spark, sf_dir):
    return conversations.digest(_table(spark, sf_dir, "conversations"))


def op13_simhash(spark, sf_dir):
    return simhash.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_url_filters, op2_mixing, op3_topk, op4_html, op5_bpe, op6_pii, op7_substrings, op8_jaccard, op9_language, op10_quality_rules,
    op11_hard_negatives, op12_conversations, op13_simhash,
)}

SQL: dict[str, str] = {
    "op1_url_filters": sql.url_filters(),
    "op2_mixing": sql.mixture(),
    "op3_topk": sql.nearest(),
    "op7_substrings": sql.repeats(),
    "op8_jaccard": sql.groups(),
    "op10_quality_rules": sql.quality_rules(),
    "op11_hard_negatives": sql.hard_negatives(),
    "op12_conversations": sql.conversations_repair(),
}
