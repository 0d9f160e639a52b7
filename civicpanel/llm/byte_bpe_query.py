"""Byte-level BPE of ``documents`` and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm import byte_bpe
from civicpanel.llm.common import tables
from civicpanel.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    docs = tables(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "split_tokens"
    )
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    decoded = byte_bpe.decode(encoded.withColumn("ids_sha256", digest), RANKS, texts=False)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"), "split_tokens")
