"""Hard negatives against all pairs in plain Python; intervals against exact scores."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from civicpanel.llm import hard_negatives as hn
from civicpanel.llm.negatives_query import NEGATIVES_SQL, op12_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score double"


def plain(rows, positives=5, negatives=10, low=30, high=90, every=100):
    """Sorted results for rows (id, vector, label)."""
    used = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for at, (i, v, label) in enumerate(used):
        if i is None or i % every:
            continue
        others = [(j, score(v, w), k) for n, (j, w, k) in enumerate(used) if n != at]
        for p in sorted((o for o in others if o[2] == label), key=order)[:positives]:
            fit = sorted((o for o in others if o[2] != label and low * p[1] <= 100 * o[1] <= high * p[1]), key=order)[:negatives]
            out += [(i, p[0], r, o[0], p[1], o[1]) for r, o in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, k, "x", 0.0) for i, v, k in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(df.repartition(3), F.col("vec_id") % 100 == 0, **more).collect()), key=str)


def vectors(rng, n, wide, spread=0.6):
    centres = rng.standard_normal((6, wide))
    labels = rng.integers(0, 6, n)
    found = centres[labels] + spread * rng.standard_normal((n, wide))
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    return [(i, [float(x) for x in v.astype(np.float32)], int((k + (i % 7 == 0)) % 6)) for i, (v, k) in enumerate(zip(found, labels))]


@pytest.mark.parametrize("wide", [3, 64, 70])
def test_equals_all_pairs(spark, monkeypatch, wide):
    """Small chunks, blocks and tiles, so that rows and anchors meet in many of them."""
    monkeypatch.setattr(hn, "CHUNK_CELLS", 64 * 100)
    monkeypatch.setattr(hn, "BLOCK", 16)
    rng = np.random.default_rng(wide)
    rows = [(10 * i if i % 3 else i, v, k) for i, v, k in vectors(rng, 900, wide)]
    found = mined(spark, rows)
    assert found == plain(rows) and len(found) > 300


def test_many_labels(spark, monkeypatch):
    """Tiles of anchors with several labels each, labels without anchors, and anchors without alike rows."""
    monkeypatch.setattr(hn, "TILE", 4)
    rows = [(100 * i if i % 3 else i, v, (i * i) % 71 - 5) for i, (_, v, _) in enumerate(vectors(np.random.default_rng(4), 300, 9))]
    found = mined(spark, rows)
    assert found == plain(rows) and len(found) > 1000


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(rng.choice([4, 5, 9]))], rng.randint(0, 2)) for i in range(120)]
    rows += [(100, [0.5, 0.5], 1), (100, [0.5, 0.5], 1), (100, [0.1, 0.9], 2), (200, None, 1), (300, [1.0], None), (400, [nan, 1.0], 1),
             (500, [inf], 1), (600, [None, 1.0], 1), (700, [], 1), (None, [0.5, 0.5], 1), (None, [0.3, 0.1], 2), (-100, [0.5, 0.25], 0),
             *[(7, [0.4, 0.4], 2)] * 30, *[(900 + i, [0.5, 0.5], 1) for i in range(30)]]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, [r for r in rows if r[0] and r[0] % 100]) == []
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_huge_components(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(8)], i % 3) for i in range(60)]
    rows += [(100, [8e5] * 8, 0), (101, [7e5] * 8, 1), (103, [1e30] * 8, 0)]
    usual = lambda rows: [r for r in rows if r[1] != 103]
    found, expected = mined(spark, rows), plain(rows)
    assert usual(found) == usual(expected) and len(usual(found)) > 10


def test_intervals_hold_and_filter():
    """Every score is inside its interval, and most intervals cannot reach the best five."""
    rng = np.random.default_rng(1)
    rows = vectors(rng, 3000, 64, spread=0.15)
    flips = hn.signs(64)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "label": [r[2] for r in rows], "anchor": [r[0] % 100 == 0 for r in rows],
                                        "vector": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})
    chunk = hn.Chunk.read(hn.chunk_rows(batch, flips, 0))
    places = np.arange(0, 3000, 100)
    row = {"block": 0, "ids": chunk.ids[places], "chunks": [0] * 30, "places": places, "labels": chunk.labels[places], "vectors": chunk.vectors[places].tobytes()}
    block = hn.Block(row, flips)
    low, high = hn.intervals(block, slice(0, 30), chunk)
    exact = chunk.vectors[places] @ chunk.vectors.T
    assert (low <= exact).all() and (exact <= high).all()
    state = hn.Positives(row, flips, 5)
    half = chunk.__class__(1, *[getattr(chunk, f) for f in ("ids", "labels", "vectors", "codes", "aligned", "lengths")])
    first = state.meet(chunk)
    assert state.meet(half) <= first


def test_nothing_is_broadcast_and_passes_write_only_the_best(spark, monkeypatch):
    """Equal vectors compress to files below any broadcast limit; several passes over few anchors each."""
    monkeypatch.setattr(hn, "CHUNK_CELLS", 64 * 100)
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "PASS_BLOCKS", 2)
    rows = [(i if i % 4 else 100 * i, v, k) for i, (_, v, k) in enumerate(vectors(np.random.default_rng(9), 40, 64) * 10)]
    batch = "spark.sql.parquet.columnarReaderBatchSize"
    plans, held, kept, usual = [], [], {}, spark.conf.get(batch)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def written(df, name, *more):
        plans.append(plan(df))
        held.append(int(spark.conf.get(batch)))
        kept.setdefault(name, []).append(df := write(df, name, *more))
        return df

    write = hn.written
    monkeypatch.setattr(hn, "written", written)
    df = spark.createDataFrame([(i, v, k, "x", 0.0) for i, v, k in rows], SCHEMA)
    mined = hn.hard_negatives(df.repartition(3), F.col("vec_id") % 100 == 0)
    assert "Join" in plan(mined) and not any("Broadcast" in p for p in [*plans, plan(mined)])
    assert sorted(map(tuple, mined.collect()), key=str) == plain(rows)
    assert max(held) <= 64 and spark.conf.get(batch) == usual  # chunks and blocks are wide rows
    assert len(kept["positives"]) == len(kept["negatives"]) == 4
    for name, k in (("positives", 5), ("negatives", 10)):
        for df in kept[name]:
            assert df.groupBy("block", "anchor", "target").count().agg(F.max("count")).first()[0] == k


def test_rotation_keeps_lengths():
    rows = np.random.default_rng(0).standard_normal((20, 128))
    turned = hn.rotated(rows, hn.signs(128))
    assert np.allclose(turned @ turned.T, rows @ rows.T)


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.1"
    found = sorted(map(tuple, op12_hard_negatives(spark, folder).collect()))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        assert sorted(db.execute(NEGATIVES_SQL).fetchall()) == found
    assert len(found) > 500
