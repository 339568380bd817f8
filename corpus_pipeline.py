"""The corpus pipeline: from raw documents to a mixed, deduplicated and tokenised corpus.

Every stage reads what the stage before it has written, and works on all of it. The stages up to
the mix return rows of ``documents`` with all their columns; the last one returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from ledgerline.llm import bpe, line_rules, mixing, near_dups, quality_model
from ledgerline.llm.rows import read
from ledgerline.session import materialize

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not mostly boilerplate lines."""
    return line_rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled raw documents, takes for good."""
    model = quality_model.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, by shingles of five words."""
    return near_dups.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids and their digests, per row of the mix."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

# classifier, registers and merges cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
