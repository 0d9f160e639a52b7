"""Packing against piecewise best-fit decreasing and the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicpanel.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def piecewise(counts, window):
    """Fill of each window by the plain algorithm."""
    fills = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [i for i, f in enumerate(fills) if window - f >= length]
        if fitting:
            fills[max(fitting, key=lambda i: fills[i])] += length
        else:
            fills.append(length)
    return sorted(fills)


def test_runs_equal_piecewise_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        window = rng.choice([7, 16, 30])
        counts = {rng.randint(1, window): rng.randint(1, 9) for _ in range(rng.randint(1, 12))}
        fills, placed = {}, {}
        for length, rank, pieces, each, first, filled in packing.best_fit_runs(counts, window):
            for i in range(pieces):
                w, at = first + i // each, filled + i % each * length
                assert fills.get(w, 0) == at
                fills[w] = at + length
            placed[length] = placed.get(length, 0) + pieces
            assert rank + pieces == placed[length]
        assert placed == counts
        assert sorted(fills.values()) == piecewise(counts, window)


def test_tightest_room():
    tree = packing.Capacities(10)
    assert tree.tightest(0) is None
    for room in (3, 7, 10):
        tree.set(room, True)
    assert [tree.tightest(x) for x in (0, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    tree.set(7, False)
    assert tree.tightest(4) == 10


def test_pieces_hold_every_id_once(make_docs):
    rows = [
        (1, "the quick brown fox " * 900),
        (2, None),
        (3, ""),
        (4, "Ééanon anieroi\n\n  la  euxen 1234567 <|endoftext|> x"),
        (4, "same id, other text"),
        (None, "no id"),
        (5, "a" * 5000 + " b"),
        (6, "the quick brown fox " * 900),
    ]
    docs = make_docs(rows).withColumns({"part": F.lit(1), "rank": F.lit("x"), "length": F.lit(0)})
    found = packing.pack(docs, PATH, window=256).collect()
    exact = Tokenizer.from_file(PATH)
    expected = sorted(
        np.array([*exact.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in rows
    )
    whole, order = {}, sorted(found, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start))
    twins = [r for r in order if r.doc_id in (1, 6)]
    for r in order:
        whole.setdefault((r.doc_id, r.doc_tokens), b"")
        assert len(whole[r.doc_id, r.doc_tokens]) == 4 * r.start
        whole[r.doc_id, r.doc_tokens] += r.ids
    assert sorted(whole.values()) == expected and len(twins) > 2
    places = {}
    for r in sorted(found, key=lambda r: r.offset):
        assert places.get(r.sequence_id, 0) == r.offset
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 256 and sorted(places) == list(range(len(places)))
    joined = packing.sequences(packing.pack(docs, PATH, window=256)).collect()
    assert sum(len(r.ids) for r in joined) == sum(map(len, expected))
    assert all(len(r.ids) == 4 * r.tokens for r in joined)


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), PATH).collect() == []


def test_query_is_tight(spark, data):
    from civicpanel.llm.queries import op1_packing

    found = op1_packing(spark, data).collect()
    exact, docs = Tokenizer.from_file(PATH), {
        r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()
    }
    for r in found[:100]:
        ids = np.array([*exact.encode(docs[r.doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        assert len(ids) == r.doc_tokens
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert sum(r.doc_tokens for r in found if r.start == 0) == sum(r.length for r in found)
    windows = 1 + max(r.sequence_id for r in found)
    assert sum(r.length for r in found) > 0.97 * 2048 * (windows - 1)
