"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe, chat, exact_dedup, near_dedup, packing, quality, repair, secret_scan, topk, toxicity, trie, url_filter, warc
from clickloom.llm.common import importable

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(warc.captures_of(table(spark, sf_dir, "pages")))
    return resolved.withColumn("headers", warc.header_text())


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(given.unionByName(extra)))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


REGISTERED: list[Query] = [
    op1_packing,
    op2_exact_dedup,
    op3_topk,
    op4_warc,
    op5_byte_bpe,
    op6_chat,
    op7_url_filter,
    op8_toxicity,
    op9_secret_scan,
    op10_near_dedup,
    op11_quality,
    op12_repair,
    op13_prefix_trie,
]


def llm_queries() -> dict[str, Query]:
    return {query.__name__: query for query in REGISTERED}
