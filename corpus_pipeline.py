"""From raw documents to token ids: five stages, each applied to all rows the one before kept.

run(spark, sf_dir) writes every stage as Parquet below spark.checkpoint.dir and reads it again for
the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import bpe, decontam, near, pii, quality
from tradewatch.llm.scratch import checkpoint_dir, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    ship_package(spark)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies, five-word similarity 0.8, the document of smallest id stays."""
    ship_package(spark)
    return near.keep_one(docs)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item, exact or edited, go."""
    ship_package(spark)
    return decontam.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks."""
    ship_package(spark)
    return pii.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, their number, and whether decoding gives the text again."""
    ship_package(spark)
    texts = docs.select("doc_id", "lang", "source", "text", F.col("text").alias("was"))
    return bpe.Codec(spark, bpe.default_path()).round_trip(texts).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("was", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("benchmark", no_benchmark_passages),
    ("personal_data", no_personal_data),
    ("tokens", token_ids),
]

# Fingerprints, alignments and merges are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
