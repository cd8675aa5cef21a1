"""A training corpus from raw documents: judged, filtered, deduplicated, mixed and encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``. ``sf_dir`` is only read for labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import mixing, quality_classifier, quality_rules, sentencepieces, simhash
from daybook.llm.common import durable, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, gives at least even odds of being good."""
    weights = quality_classifier.train(docs, read(spark, sf_dir, "labels"), "quality", folds=3, fold=1)
    scored = quality_classifier.score(docs, docs.columns, weights)
    return scored.where(F.col("score") >= quality_classifier.THRESHOLD).select("row.*")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    measured = quality_rules.measure(docs, docs.columns)
    limits = durable(quality_rules.fences(quality_rules.sketches(quality_rules.measure(docs, ["lang"]))), "fences")
    return quality_rules.judge(measured, limits).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest key."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, repeated as often as it takes them."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix as ids of pieces, best segmentation first, with its best scores."""
    encoded = sentencepieces.encode(docs, ["doc_id", "lang", "source"])
    return encoded.select("row.*", *sentencepieces.OUTPUTS.names)


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("simhash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("sentencepiece encoding", encode),
]

#: Hashes, learning and segmentation cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
