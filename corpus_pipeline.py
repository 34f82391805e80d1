"""The pipeline of the `llm` package: documents in, packed sequences out.

Toxic documents go, of equal texts and of near-duplicates one document stays, secrets are
masked, and what is left is tokenized and packed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import exact_dedup, near_dedup, packing, secret_scan, toxicity
from clickloom.llm.common import discard, importable, modest_batches, stored
from clickloom.llm.queries import WORD_TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored below the mark of rejection."""
    importable(spark)
    modest_batches(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    importable(spark)
    modest_batches(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id."""
    importable(spark)
    modest_batches(spark)
    return near_dedup.without_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found masked; `n_chars` follows the text."""
    masked = secret_scan.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    importable(spark)
    modest_batches(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Toxicity, near-duplicates and tokenizing have no form in SQL; tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
