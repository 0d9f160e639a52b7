"""Near duplicates against all pairs of full sets, and awkward documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

from civicpanel.llm import near_duplicates as nd
from civicpanel.llm.components import connected

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words, percent=80):
    """Components from every pair."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    home = {i: i for i in sets}

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if not a or not b or min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                home[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def planted(rng, groups, copies, length, edits):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        rows.append(" ".join(base))
        rows += [" ".join(edited(rng, base, rng.randint(0, edits))) for _ in range(copies)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("words, groups, copies, length, edits", [(2, 30, 6, 120, 16), (5, 30, 6, 150, 9), (2, 1, 700, 100, 12)])
def test_equals_all_pairs(make_docs, words, groups, copies, length, edits):
    rows = planted(random.Random(words + groups), groups, copies, length, edits)
    assert sorted(map(tuple, nd.near_duplicates(make_docs(rows), words).collect())) == brute(rows, words)


def test_blocks_and_deep_regions_change_nothing(make_docs, monkeypatch):
    rows = planted(random.Random(5), 2, 90, 80, 10)
    monkeypatch.setattr(nd, "BLOCK", 2_000)
    monkeypatch.setattr(nd, "REGION", 8)
    assert sorted(map(tuple, nd.near_duplicates(make_docs(rows), 2).collect())) == brute(rows, 2)


def test_many_tails_of_one_text(make_docs):
    """Copies that are alike to the base but not to each other: all depend on meeting the base."""
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))] + [(i, " ".join(base + [f"t{i}x{j}" for j in range(49)])) for i in range(1, 4001)]
    found = nd.near_duplicates(make_docs(rows), 2).collect()
    assert {r.component_id for r in found} == {0} and [r.doc_id for r in found if r.kept] == [0]


def test_no_crowded_region_is_collected(make_docs, monkeypatch):
    """A thousand near copies share most regions; no task holds one of them."""
    whole = nd.runs

    def bounded(batches, *keys):
        for group in whole(batches, *keys):
            assert keys != ("region",) or len(group) <= 256
            yield group

    monkeypatch.setattr(nd, "runs", bounded)
    text = " ".join(f"w{i}" for i in range(300))
    found = nd.near_duplicates(make_docs([(i, f"{text} serial{i}") for i in range(1000)]), 2).collect()
    assert {r.component_id for r in found} == {0}


def test_awkward_documents(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (9, "ONE\ttwo"), (7, "Éa b"), (8, "éa b"),
            (10, "x " * 100_000), (11, "x"), (12, "y" * 300_000)]
    docs = make_docs(rows).withColumns({"id": F.lit(1), "component": F.lit("c"), "signature": F.lit(2), "_row": F.lit(3)})
    assert sorted(map(tuple, nd.near_duplicates(docs, 2).collect())) == brute(rows, 2)
    kept = nd.one_of_each(docs, 2)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 10, 11, 12]


def test_null_and_repeated_ids(make_docs):
    docs = make_docs([(3, "a b c"), (3, "a b c"), (None, "a b c"), (None, "d e f"), (None, "d e f")])
    found = sorted(map(tuple, nd.near_duplicates(docs, 2).collect()), key=str)
    assert [r[2] for r in found] == [3, 3, 3, None, None]
    assert len(nd.one_of_each(docs, 2).collect()) <= 3
    assert {r.text for r in nd.one_of_each(docs, 2).collect()} >= {"a b c", "d e f"}


def test_texts_of_one_id_are_judged_apart(make_docs):
    text = lambda name: " ".join(f"{name}{i}" for i in range(30))
    rows = [(5, text("a")), (None, text("a") + " z"), (None, text("b")), (None, text("c")), (None, text("c") + " z"),
            (7, text("d")), (8, text("d") + " z"), (8, text("e")), (9, text("e") + " z"), (6, text("f") + " z"), (8, text("f"))]
    found = [tuple(r) for r in nd.near_duplicates(make_docs(rows), 2).collect()]
    assert sorted((r[0], r[2]) for r in found if r[0]) == [(5, 5), (6, 6), (7, 7), (8, 6), (8, 7), (8, 8), (9, 8)]
    assert sorted(str(r[2]) for r in found if not r[0]) == ["5", "None", "None", "None"]
    kept = {r.text for r in nd.one_of_each(make_docs(rows), 2).collect()}
    assert len(kept) == 6 and kept - {text("c"), text("c") + " z"} == {text("a"), text("b"), text("d"), text("e"), text("f") + " z"}


def test_empty_table(make_docs):
    assert nd.near_duplicates(make_docs([])).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    home = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            home[a] = home[b] = min(home[a], home[b])
    assert found == {x: c for x, c in home.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_query(spark, data):
    from civicpanel.llm.queries import op4_near_duplicates

    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op4_near_duplicates(spark, data).collect())) == brute(rows, 2)
