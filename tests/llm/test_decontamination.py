"""Leaks against containment of whole items and planted paraphrases; subsequences against a table."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicpanel.llm import decontamination as dc


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_common_words():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(1, 6) for _ in range(rng.randint(1, 40))] for _ in range(2))
        assert dc.common_words(np.array(a, np.uint64), np.array(b, np.uint64)) == table_lcs(a, b)
        whole, first = dc.Subsequence(np.array(a, np.uint64)), rng.randrange(len(a))
        hits = whole.places_in(np.array(b, np.uint64))
        assert whole.longest(hits, first) == table_lcs(a[first:], b) and whole.most(hits) >= whole.longest(hits)


def test_space_spans_the_leading_directions(spark):
    """The latent space holds what a full SVD of the same rows holds."""
    rng = np.random.default_rng(0)
    dense = rng.standard_normal((60, 12)) @ rng.standard_normal((12, 40))
    rows = spark.createDataFrame([(bytearray(np.arange(40, dtype=np.int32).tobytes()), bytearray(r.tobytes())) for r in dense], "terms binary, values binary")
    basis, _ = np.linalg.qr(rng.standard_normal((40, 20)))
    for _ in range(2):
        basis, _ = np.linalg.qr(dc.products(rows.repartition(3), basis)[0])
    _, inner = dc.products(rows, basis)
    found = np.sqrt(np.sort(np.linalg.eigvalsh(inner))[::-1][:12])
    assert np.allclose(found, np.linalg.svd(dense, compute_uv=False)[:12], rtol=1e-6)


WORD = re.compile(r"[0-9a-z\x80-\U0010ffff_]+")


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "lo", "mi")] + ["the"] * 40 + ["of"] * 30
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [[f"key{i}x{j % 9}" if j % 3 == 0 else rng.choice(vocabulary) for j in range(rng.randint(15, 60))] for i in range(30)]
    docs, truth = [], set()
    for d in range(240):
        words = prose(rng.randint(50, 900))
        if d % 6 == 0:
            item = rng.randrange(30)
            copy = list(items[item])
            if d % 12 == 0:  # a paraphrase: a fifth of the words of its first three quarters replaced
                for j in rng.sample(range(3 * len(copy) // 4), len(copy) // 5):
                    copy[j] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = copy
            truth.add((d, item))
        docs.append((d, " ".join(words).capitalize() + "."))
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)], truth


def test_planted_leaks(spark, make_docs, planted):
    docs, items, truth = planted
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.leaks(make_docs(docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth and len(found) == len(truth)
    kept = dc.without_leaks(make_docs(docs).withColumn("clean", F.lit(1)), benchmark)
    assert kept.columns[-1] == "clean"
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in truth}


def test_blocks_change_nothing(spark, make_docs, planted, monkeypatch):
    docs, items, truth = planted
    monkeypatch.setattr(dc, "BLOCK", 11)
    found = dc.leaks(make_docs(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth


def test_items_copied_into_many_rows(spark, make_docs, planted):
    """An item in a third of the rows, and one of words that every row has, beside ordinary ones."""
    docs, items, truth = planted
    hot, frequent = [f"hot{j}" for j in range(30)], [f"all{j}" for j in range(20)]
    rows, expected = [], set(truth)
    for d, text in docs:
        shuffled = random.Random(d).sample(frequent, 20)
        rows.append((d, " ".join([text, *(hot if d % 3 == 0 else ()), *(frequent if d % 40 == 1 else shuffled)])))
        expected |= {(d, 90)} if d % 3 == 0 else {(d, 91)} if d % 40 == 1 else set()
    benchmark = spark.createDataFrame([*items, (90, " ".join(hot)), (91, " ".join(frequent))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.leaks(make_docs(rows), benchmark).collect()} >= expected


def test_awkward_rows(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven twelve"
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "alpha beta gamma"), (5, "long " * 300)], "item_id long, text string")
    rows = [(1, item.upper()), (1, item.upper()), (2, None), (3, ""), (None, f"x, {item}!"), (4, "word " * 100_000 + item), (5, "y" * 200_000),
            (6, "alpha z beta gamma"), (7, "alpha beta")]
    docs = make_docs(rows + [(100 + i, f"other text {i} entirely") for i in range(60)])
    found = {(r.doc_id, r.item_id) for r in dc.leaks(docs, benchmark).collect()}
    assert found == {(1, 1), (None, 1), (4, 1), (6, None)}
    assert dc.without_leaks(docs, benchmark).count() == 69 - 5
    assert dc.leaks(make_docs([]), benchmark).collect() == []
    assert dc.leaks(docs, benchmark.where("false")).collect() == []


def test_recall_of_paraphrases(spark, make_docs):
    """Paraphrases that the check accepts are found, of the benchmark and in the texts of the test data."""
    folder, rng = "/root/testdata/sf0.1", random.Random(8)
    texts = [WORD.findall((r.text or "").lower()) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(900).collect()]
    items = {r.item_id: WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    every = [w for t in texts for w in t]
    texts = [t for t in texts if len(t) > 120]
    hashes = dc.RunHashes(dc.TERM_BYTES)
    numbers = lambda words: hashes(dc.bytes_of(" ".join(words)))
    docs, planted = [], {}
    for replaced, inserted in ((0.3, 0), (0.4, 0), (0.45, 0), (0.3, 2), (0.3, 1), (0.45, 1)):
        for item, words in items.items():
            copy = list(words)
            for i in rng.sample(range(3 * len(copy) // 4), min(3 * len(copy) // 4, int(replaced * len(copy)))):
                copy[i] = rng.choice(every)
            if inserted:
                copy = [x for i, w in enumerate(copy) for x in ([w, rng.choice(every)] if i % inserted == 0 else [w])]
            common, tail = (dc.common_words(t, numbers(copy)) / len(t) for t in (numbers(words), numbers(words)[-max(1, len(words) // 4) :]))
            if common >= dc.VERBATIM or (common >= dc.PARAPHRASE and tail >= dc.ANSWER):
                text = rng.choice(texts)
                at = rng.randrange(len(text))
                planted[len(docs)] = ((replaced, inserted), item)
                docs.append((len(docs), " ".join(text[:at] + copy + text[at:])))
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in dc.leaks(make_docs(docs).repartition(8), benchmark).collect()}
    for kind in {k for k, _ in planted.values()}:
        hits = [(d, i) in found for d, (k, i) in planted.items() if k == kind]
        assert sum(hits) >= 0.95 * len(hits), (kind, sum(hits), len(hits))


def test_query_finds_every_whole_item(spark):
    from civicpanel.llm.queries import op6_decontamination

    folder = "/root/testdata/sf0.1"
    plain = lambda t: " " + " ".join(WORD.findall((t or "").lower())) + " "
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    truth = {(d, i) for d, t in docs.items() for i, w in items.items() if w in t}
    found = {(r.doc_id, r.item_id): r for r in op6_decontamination(spark, folder).collect()}
    assert truth <= set(found) and len(truth) > 20
    assert len(found) <= 1.02 * len(truth)
