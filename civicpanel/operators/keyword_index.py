"""Keyword search by stored posting lists: which rows have a word in their text, without reading every text.

A row is listed under each three letters in a row that its lower-cased text has. A word can only
be in rows that are on the lists of all its letter triples; their texts are then tested. Lists
and texts are stored in partitions by hash, so a search reads the partitions of its triples and,
where Spark prunes at run time, those of the rows found. A list is stored in pieces, one for each
some hundred rows that were indexed together: far fewer records than rows times triples.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.functions.expressions import mentions_any
from civicpanel.sources.frames import literal_frame
from civicpanel.sources.scratch import new_folder

SIZE = 3
#: Texts in one Arrow batch, and listings after which the pieces of their lists are handed on.
BATCH_ROWS, LISTINGS = 512, 1 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def triples(text: str) -> np.ndarray:
    """Distinct runs of three characters of a text, each as one number, in ascending order; none for a shorter one."""
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:])


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(trigrama, chaves) from (key, lower-cased text): pieces of posting lists."""
    for batch in batches:
        keys, found, size, start = batch.column(0), [], 0, 0
        texts = batch.column(1).cast(pa.binary())
        for i, text in enumerate(texts):
            found.append(triples((text.as_py() or b"").decode(errors="replace")))
            size += len(found[-1])
            if size >= LISTINGS or i + 1 == len(texts):
                if size:
                    yield pieces(keys.slice(start, len(found)), found)
                found, size, start = [], 0, i + 1


def pieces(keys: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
    """One record for each letter triple, with the keys of all texts that have it."""
    triple = np.concatenate(found)
    order = np.argsort(triple, kind="stable")
    triple = triple[order]
    first = np.flatnonzero(np.append(True, triple[1:] != triple[:-1]))
    owners = np.repeat(np.arange(len(found)), [len(f) for f in found])[order]
    ends = pa.array(np.append(first, len(triple)), pa.int32())
    lists = pa.ListArray.from_arrays(ends, keys.take(pa.array(owners)))
    return pa.RecordBatch.from_arrays([pa.array(triple[first]), lists], names=["trigrama", "chaves"])


def bucket(value: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class KeywordIndex:
    """Folders of the posting lists and of the texts, and in how many partitions they are."""

    lists: str
    texts: str
    key: str
    text: str
    buckets: int
    list_schema: str
    text_schema: str

    def search(self, spark: SparkSession, words: Sequence[str]) -> DataFrame:
        """(key, text) of rows whose text has any of the words, in upper or lower case.

        A word of fewer than three letters is on no list: then every text is tested. No word
        at all finds nothing.
        """
        wanted = sorted({w.lower() for w in words if w})
        texts = spark.read.schema(self.text_schema).parquet(self.texts)
        if not wanted:
            return texts.where("false").select(self.key, self.text)
        tested = mentions_any(self.text, wanted)
        if min(map(len, wanted)) < SIZE:
            return texts.where(tested).select(self.key, self.text)
        return texts.join(self.candidates(spark, wanted), ["_balde", self.key], "left_semi").where(tested).select(self.key, self.text)

    def candidates(self, spark: SparkSession, words: Sequence[str]) -> DataFrame:
        """(key, _balde) of rows that have all letter triples of a word."""
        parts = [(w, t) for w in sorted(set(words)) for t in triples(w).tolist()]
        pairs = literal_frame(spark, parts, "_palavra STRING, trigrama BIGINT")
        needed = pairs.groupBy("_palavra").agg(F.count(F.lit(1)).alias("_precisa"))
        three = sorted({t for _, t in parts})
        # Their partitions, by the same hash, so that the others are not read.
        numbers = [r[0] for r in pairs.select(bucket("trigrama", self.buckets)).distinct().collect()]
        lists = spark.read.schema(self.list_schema).parquet(self.lists)
        lists = lists.where(F.col("_balde").isin(numbers) & F.col("trigrama").isin(three)).drop("_balde")
        each = lists.join(pairs, "trigrama").select("_palavra", F.explode("chaves").alias(self.key))
        met = each.groupBy("_palavra", self.key).agg(F.count(F.lit(1)).alias("_tem"))
        found = met.join(needed, "_palavra").where(F.col("_tem") == F.col("_precisa")).select(self.key).distinct()
        return found.withColumn("_balde", bucket(self.key, self.buckets))


def build(df: DataFrame, key: str, text: str, buckets: int = 64, folder: str | None = None) -> KeywordIndex:
    """Store the posting lists and texts of rows with unique keys, not NULL."""
    root = folder or new_folder(df.sparkSession, "keyword_index")
    rows = df.select(key, text).where(F.col(key).isNotNull())
    texts = rows.withColumn("_balde", bucket(key, buckets))
    texts.hint("rebalance", "_balde").write.partitionBy("_balde").parquet(f"{root}/texts")
    kind = dict(df.dtypes)[key]
    before = df.sparkSession.conf.get(ARROW_ROWS)
    df.sparkSession.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    try:
        lists = rows.select(key, F.lower(text).alias("_texto")).mapInArrow(listed, f"trigrama long, chaves array<{kind}>")
        lists = lists.withColumn("_balde", bucket("trigrama", buckets)).hint("rebalance", "_balde")
        lists.sortWithinPartitions("_balde", "trigrama").write.partitionBy("_balde").parquet(f"{root}/lists")
    finally:
        df.sparkSession.conf.set(ARROW_ROWS, before)
    return KeywordIndex(
        f"{root}/lists", f"{root}/texts", key, text, buckets,
        f"trigrama BIGINT, chaves ARRAY<{kind}>, _balde INT", f"`{key}` {kind}, `{text}` STRING, _balde INT",
    )
