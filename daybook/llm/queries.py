"""Registered queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    conversations,
    exact_dedup,
    hard_negatives,
    language_id,
    licenses,
    mixing,
    nearest,
    quality_classifier,
    quality_rules,
    sentencepieces,
    simhash,
    toxicity,
    wrappers,
)
from daybook.llm.common import durable, read
from daybook.llm.sql import EXACT_DEDUP, HARD_NEGATIVES, LICENSES, QUALITY_RULES


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def quality_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_classifier.classify(docs, labels, "quality", folds=3, fold=1)


def piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(read(spark, sf_dir, "documents"), ["doc_id"]).select("row.doc_id", *sentencepieces.OUTPUTS.names)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.score(docs, labels, "toxic", folds=5, fold=0)


def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"), folds=3, fold=1)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def rules_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.measure(read(spark, sf_dir, "documents"), ["doc_id"])
    measured = durable(measured, "measures")
    limits = durable(quality_rules.fences(quality_rules.sketches(measured)), "fences")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(measured, limits).select(F.col("row.doc_id").alias("doc_id"), *names)


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(read(spark, sf_dir, "conversations"))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_extraction,
    "op2_nearest_neighbours": nearest_neighbours,
    "op3_source_mixing": source_mixing,
    "op4_simhash_near_dedup": simhash_near_dedup,
    "op5_sentencepiece": piece_encoding,
    "op6_toxicity": toxicity_scores,
    "op7_quality_classifier": quality_classification,
    "op8_language_id": language_identification,
    "op9_license_scan": license_scan,
    "op10_quality_rules": rules_verdict,
    "op11_exact_dedup": exact_duplicates,
    "op12_conversation_repair": conversation_repair,
    "op13_hard_negatives": mined_negatives,
}

SQL: dict[str, str] = {
    "op9_license_scan": LICENSES,
    "op10_quality_rules": QUALITY_RULES,
    "op11_exact_dedup": EXACT_DEDUP,
    "op13_hard_negatives": HARD_NEGATIVES,
}
