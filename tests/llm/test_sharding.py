"""Exact sizes, uniformity and the law of a single draw."""

import math
from collections import Counter

from pyspark.sql import functions as F

from civicpanel.llm import sharding


def test_draws_follow_the_law(spark):
    n, cases = 20_000, [(7, 5, 6), (3, 40, 10), (50, 50, 60), (0, 5, 3), (4, 0, 3), (0, 0, 0)]
    for good, bad, draws in cases:
        col = lambda x: F.lit(x).cast("long")
        k = sharding.hypergeometric(col(good), col(bad), col(draws), sharding.uniform(F.lit(5), F.col("id")))
        seen = Counter(r[0] for r in spark.range(n).select(k).collect())
        every = math.comb(good + bad, draws)
        for value in range(draws + 1):
            p = math.comb(good, value) * math.comb(bad, draws - value) / every if draws - value >= 0 else 0
            assert abs(seen[value] / n - p) < 5 * math.sqrt(max(p * (1 - p), 1e-9) / n) + 1e-9, (good, bad, draws, value)


def test_matrix_has_exact_sums(spark):
    sizes = {i: (i * 37) % 50 for i in range(23)}
    found = sharding.communication_matrix(
        spark.createDataFrame(list(sizes.items()), "part int, n long"), 7, seed=3
    ).collect()
    assert {r.part: sum(r.counts) for r in found} == sizes
    columns = [sum(r.counts[s] for r in found) for s in range(7)]
    assert sum(columns) == sum(sizes.values()) and max(columns) - min(columns) <= 1


def test_shards_are_exact_and_repeatable(spark):
    rows = spark.range(0, 1003, 1, 9).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.lit(4)).alias("doc_id"), F.col("id").alias("part"), F.lit("x").alias("shard")
    )
    found = sharding.shuffled(rows, 40, seed=1).collect()
    assert sorted(r.part for r in found) == list(range(1003))
    per_shard = Counter(r.shard for r in found)
    assert len(per_shard) == 40 and set(per_shard.values()) == {25, 26}
    for s in range(40):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(per_shard[s]))
    again = {(r.part, r.shard, r.slot) for r in sharding.shuffled(rows, 40, seed=1).collect()}
    assert again == {(r.part, r.shard, r.slot) for r in found}
    other = {(r.part, r.shard, r.slot) for r in sharding.shuffled(rows, 40, seed=2).collect()}
    assert len(other & again) < 30


def test_few_and_no_rows(spark):
    found = sharding.shuffled(spark.range(3), 40).collect()
    assert len({r.shard for r in found}) == 3 and {r.slot for r in found} == {0}
    assert sharding.shuffled(spark.range(0), 40).collect() == []


def test_places_are_uniform(spark):
    """Over seeds, a given row reaches every shard and neighbours part as often as chance has it."""
    rows, hits, together = spark.range(0, 40, 1, 4), Counter(), 0
    for seed in range(15):
        found = {r.id: (r.shard, r.slot) for r in sharding.shuffled(rows, 4, seed).collect()}
        hits[found[0][0]] += 1
        together += sum(found[i][0] == found[i + 1][0] for i in range(0, 40, 2))
    assert len(hits) >= 3 and max(hits.values()) <= 11
    assert abs(together / 300 - 9 / 39) < 0.1


def test_query(spark, data):
    from civicpanel.llm.queries import op7_sharding

    found = op7_sharding(spark, data).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in found) == sorted(docs)
    assert all(r["size"] == len((docs[r.doc_id] or "").encode()) + 16 for r in found)
    counts = Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
