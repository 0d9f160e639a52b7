"""Corpus preparation as a list of stages, each one of the corpus operators.

A stage takes the documents that its predecessor left and returns documents with the same
columns; the last one returns pieces of packed sequences. Null, empty, repeated and very long
texts are handled as the operators state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicpanel.llm import decontamination, near_duplicates, packing, substrings, toxicity
from civicpanel.llm.common import tables, written

#: Bytes of a passage that repeats. Shorter ones, such as licence lines, stay where they are.
REPEATED_BYTES = 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labels table, does not call toxic."""
    chain = toxicity.train(docs, tables(spark, sf_dir, "labels"), toxicity.label_categories())
    return toxicity.without_toxic(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group with a similarity of 0.8 of five-word shingles."""
    return near_duplicates.one_of_each(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; no document goes."""
    return substrings.without_repeats(docs, REPEATED_BYTES)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_leaks(docs, tables(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents as pieces of sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A trained classifier and a random projection are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
