"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from civicpanel.llm import merkle
from civicpanel.llm.manifest_query import MANIFEST_SQL, op13_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, arity):
    """The last node, and for each leaf its siblings by level as (left, right)."""
    paths, spans, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(at, min(at + arity, len(nodes))) for at in range(0, len(nodes), arity)]
        for run in runs:
            for k in run:
                for leaf in spans[k]:
                    paths[leaf].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        spans = [[x for k in run for x in spans[k]] for run in runs]
        nodes = [h(*[nodes[k] for k in run]) for run in runs]
    return nodes[0], paths


def plain_manifest(rows, arity):
    """Sorted (doc_id, leaf, path, subroot, root) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], h(*map(plain_field, row))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x))
        trees[g] = plain_tree([leaf for _, leaf in groups[g]], arity)
    root, tops = plain_tree([trees[g][0] for g in order], arity)
    return sorted(
        (
            (doc, leaf, [*path, *top], trees[g][0], root)
            for g, top in zip(order, tops)
            for (doc, leaf), path in zip(groups[g], trees[g][1])
        ),
        key=str,
    )


def spark_manifest(df, arity):
    found = merkle.merkle(df, arity=arity).collect()
    return sorted(((r.doc_id, r.leaf, [tuple(s) for s in r.path], r.subroot, r.root) for r in found), key=str)


AWKWARD = [
    (1, "s", "en", 3, "abc"), (1, "s", "en", 3, "abc"), (1, "s", "en", 3, "other"), (None, None, None, None, None),
    (None, "s", None, 0, ""), (2, "-", "-", 1, "-"), (3, "s", "", 2, "ÄÖ"), (4, "s", "ﬀ", 1, "x" * 300_000), (5, "s", "zz", 1, "1:a"),
    (-7, "s", "en", -1, "A"), *[(None, "s", "en", i, "same id") for i in range(20)], *[(i, "s", "xx", 1, "t") for i in range(100, 175)],
]


@pytest.mark.parametrize("arity", [2, 8])
def test_awkward_rows(spark, make_docs, arity):
    df = spark.createDataFrame([(d, t, g, s, n, "extra") for d, s, g, n, t in AWKWARD], "doc_id long, text string, lang string, source string, n_chars long, i string")
    assert spark_manifest(df.repartition(5), arity) == plain_manifest(AWKWARD, arity)


@pytest.mark.parametrize("n", [1, 9, 65])
def test_sizes(spark, make_docs, n):
    """Lone leaves, full runs, and runs of one at the end."""
    rows = [(i, "s", "en", 1, "a") for i in range(n)]
    df = make_docs([(i, "a") for i in range(n)])
    assert spark_manifest(df, 8) == plain_manifest(rows, 8)


def test_many_groups(spark):
    """More groups than a run, so that the tree of subroots has levels of its own."""
    rng = random.Random(1)
    rows = [(i, "s", f"g{rng.randint(0, 80)}", i, "t") for i in range(400)]
    df = spark.createDataFrame([(d, t, g, s, n) for d, s, g, n, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert spark_manifest(df, 8) == plain_manifest(rows, 8)


def test_empty_table(make_docs):
    assert merkle.merkle(make_docs([])).collect() == []


def test_hot_ids_are_spread(spark, monkeypatch):
    """A third of the rows without id are numbered by several tasks."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("key"), F.lit("2:en").alias("branch"), F.sha2(F.col("id").cast("string"), 256).alias("h")
    )
    kept, write = [], merkle.written
    monkeypatch.setattr(merkle, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = merkle.numbered(rows.repartition(8), "branch", ["key", "h"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    counts = [r["count"] for r in kept[0].where("key IS NULL").groupBy("part").count().collect()]
    assert len(counts) >= 3 and max(counts) < 6_000
    assert places.agg(F.countDistinct("i"), F.max("i"), F.min("n")).first() == (30_000, 29_999, 30_000)


def test_tampered_leaf_does_not_fold(spark, make_docs):
    found = merkle.merkle(make_docs([(i, f"text {i}") for i in range(50)]))
    bad = found.withColumn("other", F.when(F.col("doc_id") < 10, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf")))
    checked = merkle.verified(bad, "other").collect()
    assert {r.doc_id for r in checked if not r.verified} == set(range(10))


def test_query_and_sql(spark, data):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    texts = {r[0]: r for r in rows}
    expected = {r[0]: r for r in plain_manifest(rows, 8)}
    found = op13_manifest(spark, data).collect()
    assert len(found) == len(rows) and len(expected) == len(rows)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in found:
        _, leaf, path, subroot, root = expected[r.doc_id]
        row = texts[r.doc_id]
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and row[4] is not None:
            row = (*row[:4], row[4].translate(lower))
        node = h(*map(plain_field, row))
        for left, right in path:
            node = h(left, node, right)
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == h(*[left + right for left, right in path])
        assert (r.folded_root, r.verified) == (node, node == root)
    assert 0 < sum(r.verified for r in found) < len(found)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
        assert sorted(db.execute(MANIFEST_SQL).fetchall()) == sorted(map(tuple, found))
