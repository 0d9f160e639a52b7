"""One query for each corpus operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm import (
    byte_bpe_query, decontamination, fingerprints, html_text, manifest_query, near_duplicates, negatives_query, packing, sharding,
    substrings, token_counts, toxicity, url_filter,
)
from civicpanel.llm.common import tables, written
from civicpanel.llm.registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL", "byte_bpe_query", "manifest_query", "negatives_query"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces with their place in sequences of 2048 tokens."""
    pieces = written(packing.token_pieces(tables(spark, folder, "documents"), BYTE_BPE), "pieces")
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.best_fit(digests).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy word pieces of every document by a public sentencepiece vocabulary."""
    initial, inner = token_counts.sentencepiece_pieces(PIECE_BPE)
    return token_counts.token_counts(tables(spark, folder, "documents"), initial, inner, prefix="▁")


@query("op7_sharding")
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by one at most."""
    text = F.col("text").cast("binary")
    narrow = tables(spark, folder, "documents").select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return sharding.shuffled(narrow, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_html_text")
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(tables(spark, folder, "pages"))


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edited_fingerprints(tables(spark, folder, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Category probabilities and verdict of every document, learnt from the labels table."""
    docs = tables(spark, folder, "documents")
    chain = toxicity.train(docs, tables(spark, folder, "labels"), toxicity.label_categories())
    return toxicity.score(docs, chain)


HOST_RULES = [
    url_filter.HostRule("block", "net", "/"),
    url_filter.HostRule("allow", "example.net", "/en/"),
    url_filter.HostRule("block", "example.com", "/de/"),
    url_filter.HostRule("allow", "org", "/fr/"),
]

#: Host words that label a URL as unwanted, beside the labels table.
UNWANTED_WORDS = "bet bets bonus casino gambling jackpot loan loans lottery pharmacy pills poker porn viagra xxx".split()


@query("op5_url_filter")
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page's URL. Labels: low quality in the labels table, or an unwanted host word."""
    pages = tables(spark, folder, "pages").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    labels = tables(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("low"))
    words = F.split(url_filter.host_of(F.col("url")), r"[^\p{L}\p{N}]+")
    unwanted = F.coalesce(F.arrays_overlap(words, F.array(*map(F.lit, UNWANTED_WORDS))), F.lit(False))
    labelled = (
        pages.join(labels, "page_id", "left")
        .where(F.col("low").isNotNull() | unwanted)
        .select("url", (F.coalesce("low", F.lit(False)) | unwanted).alias("blocked"))
    )
    return url_filter.judge(pages, HOST_RULES, labelled)


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under a similarity of 0.8 of two-word shingles."""
    return near_duplicates.near_duplicates(tables(spark, folder, "documents"), words=2, percent=80)


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items found in each document, one row per pair."""
    return decontamination.leaks(tables(spark, folder, "documents"), tables(spark, folder, "benchmark"))


@query("op3_substrings")
def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """What repeats of 50 bytes are removed from every document, and a digest of the rest."""
    return substrings.digests(tables(spark, folder, "documents"))
