"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and gives the rows that go on; all but the last keep the
columns of ``documents``.  The tokenizers behind packing have no SQL form, so there is no
``ORACLE_SQL``; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from panelspark.llm.shipping import ship_package
from panelspark.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _ready(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity operator rejects; it learns from all labels."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, fold=None))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of those that are equal but for white space: the longest, then the smallest id."""
    _ready(spark)
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group of linked SimHash fingerprints (three-word shingles, two bits)."""
    _ready(spark)
    return simhash.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in the texts; every document stays, n_chars follows the text."""
    _ready(spark)
    return secret_scan.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into windows: one row per piece."""
    _ready(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stages are written to the shared checkpoint folder."""
    _ready(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
