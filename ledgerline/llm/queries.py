"""The registered query of every operator: whole tables in, the result's digest columns out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    bit_slices,
    bpe,
    chat,
    licenses,
    line_rules,
    mixing,
    near_dups,
    quality_model,
    resampling,
    spots,
    turn_repair,
    url_rules,
    wrappers,
)
from ledgerline.llm.rows import read

Query = Callable[[SparkSession, str], DataFrame]


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_model.train(docs, read(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts look like the template's own marks."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    return chat.digests(chat.format_events(chat.turn_events(rows.unionByName(extra))))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", *line_rules.COUNTS, "base_failed", "boilerplate_words", "kept"
    )


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages"))


# (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of two words, as the result of this query is defined."""
    return near_dups.groups(read(spark, sf_dir, "documents"), size=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.edited_likeness(read(spark, sf_dir, "documents"))


def top_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return bit_slices.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(read(spark, sf_dir, "conversations"))


def target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of ``benchmark``."""
    drawn = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": quality,
    "op2_byte_bpe": byte_bpe,
    "op3_chat_format": chat_format,
    "op4_quality_rules": rules,
    "op5_mix_sources": mix,
    "op6_html_extract": html_text,
    "op7_url_filter": url_filter,
    "op8_license_scan": license_scan,
    "op9_minhash_near_dedup": near_duplicates,
    "op10_spot_fingerprints": fingerprints,
    "op11_bit_sliced_top_k": top_neighbours,
    "op12_turn_repair": turns,
    "op13_target_resample": target_resample,
}
