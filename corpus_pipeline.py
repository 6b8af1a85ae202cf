"""A training corpus from raw documents, in stages that are each written and read again.

Quality rules drop rejected documents, one document of each group of near duplicates stays, personal data is
masked, sources are mixed to their weights, and every text becomes tokens. Each stage takes what the one
before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from facetmill.llm import bpe, jaccard, mixing, pii, quality
from facetmill.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' votes do not reject."""
    return quality.filter_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; spans of personal data are replaced by their kind."""
    return pii.mask(docs, length="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says: a repeated document is a repeated row."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every row."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "source"])
    return coded.withColumnsRenamed({"_n_tokens": "n_tokens", "_ids": "ids"}).select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix_sources),
    ("tokens", tokens),
]

#: A learned tagger, components and merges: no SQL for the whole. Tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
