"""Fingerprints against plain sorted sets, and the order of documents."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicpanel.llm import fingerprints as fp


def brute(rows, band=fp.IDF_BAND):
    """The whole result from lists, next documents from one sort."""
    buckets = fp.TermBuckets()
    of = lambda t: {int(buckets(w)[0]) for w in re.findall(r"[0-9a-z_\x80-\U0010ffff]+", t.lower())}
    df = {}
    for _, t in rows:
        for b in of(t or ""):
            df[b] = df.get(b, 0) + 1
    low, high = (len(rows) / math.exp(x) for x in reversed(band))
    inside = {b for b, n in df.items() if low <= n <= high}

    def fingerprint(t):
        terms = of(t)
        return fp.Fingerprinter.of_terms(np.array(sorted(terms & inside or terms), np.uint32))

    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = []
    for at, (i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out)


def test_query_equals_brute_force(spark, data):
    from civicpanel.llm.queries import op10_fingerprints

    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, op10_fingerprints(spark, data).collect()))
    assert found == brute(rows)
    near = [r[5] for r in found if r[1] > 200]
    far = [r[6] for r in found if r[1] > 200]
    assert np.mean(near) > 3 * np.mean(far)


def test_awkward_documents(spark, make_docs):
    rows = [(5, "Same text, twice"), (9, "Same text, twice"), (-3, None), (4, ""), (2, "  ,.!"), (70, "é" * 100_001), (11, "a b")]
    found = sorted(map(tuple, fp.edited_fingerprints(make_docs(rows)).collect()))
    assert found == brute(rows)
    by_id = {r[0]: r for r in found}
    assert by_id[5][3] == by_id[9][3] and by_id[4][3] == by_id[2][3] == fp.EMPTY * fp.DRAWS * fp.SIZES


def test_null_and_repeated_ids(make_docs):
    rows = [(1, "a b c"), (1, "a b c"), (None, "x y"), (None, "z"), (1, "d e f")]
    docs = make_docs(rows).selectExpr("*", "1 AS tail", "2 AS range", "'k' AS key", "'h' AS hash")
    found = fp.edited_fingerprints(docs).collect()
    assert len(found) == 5 and sum(r.doc_id is None for r in found) == 2
    assert len({r.fingerprint for r in found}) == 4


def test_many_rows_without_id_are_spread(spark, make_docs):
    """A third of the rows without id: no task has far more rows than the median, every row has its next one."""
    rows = [(i if i % 3 else None, f"text {i}") for i in range(9_000)] + [(5, f"again {i}") for i in range(900)]
    placed = fp.with_next(make_docs(rows).repartition(8))
    counts = sorted(r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect())
    assert len(counts) >= 20 and counts[-1] <= 2 * counts[len(counts) // 2]
    found = placed.where("tail = 0").select("key", "hash").collect()
    assert len(found) == len(rows)
    next_of = {}
    for part in placed.select("range", "tail", "key", "hash", "text").collect():
        next_of.setdefault(part.range, []).append((part.tail, -part.key, -part.hash, part.text))
    order = sorted(((-r.key, -r.hash) for r in found))
    starts = [min(v)[1:3] for _, v in sorted(next_of.items(), reverse=True)]
    assert starts == sorted(starts) and starts[0] == order[0]
    assert all(max(v)[0] == 1 for v in next_of.values())


def test_cuts_of_hot_keys():
    keys, hashes = np.array([-(2**63), -(2**63), 4, 9]), np.array([-(2**62), 2**62, -(2**63), -(2**63)])
    rows = [(-(2**63), -(2**63), 0), (-(2**63), 0, 1), (-(2**63), 2**63 - 1, 2), (3, 5, 2), (4, -(2**63), 3), (8, 1, 3), (9, 0, 4), (10, -5, 4)]
    k, h, expected = (np.array(x) for x in zip(*rows))
    assert fp.range_numbers((keys, hashes), k, h).tolist() == expected.tolist()


@pytest.mark.parametrize("rows", [[], [(1, "only one")]])
def test_tiny_tables(make_docs, rows):
    found = fp.edited_fingerprints(make_docs(rows)).collect()
    assert len(found) == len(rows)
    assert all(r.near_next == 1.0 for r in found)
    assert fp.fingerprints(make_docs(rows)).count() == len(rows)
