"""Held-out accuracy of the chain, and awkward documents."""

import pytest
from pyspark.sql import functions as F

from civicpanel.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Half of the labels train; texts of the other half are found by the words they were given."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"), toxicity.label_categories())
    found = toxicity.score(docs, chain).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id")
    # The labels call some texts toxic that have no word to tell: those cannot be found.
    insults = "idiot|moron|scum|loser|trash|clown|stupid|pathetic|worthless|disgusting"
    said = docs.select("doc_id", F.lower("text").rlike(rf"\b({insults})\b").alias("said"))
    rows = found.join(said, "doc_id").collect()
    telling = [r for r in rows if r.truth == 1 and r.said]
    clean = [r for r in rows if r.truth == 0]
    assert len(telling) > 100 and sum(r.toxic for r in telling) >= 0.97 * len(telling)
    assert sum(r.toxic for r in clean) <= 0.01 * len(clean)


@pytest.fixture(scope="module")
def chain(spark):
    rows = [(i, f"word{i % 7} plain text " + ("insult again" if i % 5 == 0 else "fine")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(400)] + [(3, None, 1), (9999, 0, 1), (None, 1, 1)], LABELS)
    return toxicity.train(docs, labels, toxicity.label_categories())


def test_awkward_documents(make_docs, chain):
    rows = [(1, None), (2, ""), (3, "an INSULT!"), (3, "an INSULT!"), (None, "insult"), (5, "fine " * 200_000), (6, "x" * 100_000)]
    docs = make_docs(rows).withColumns({"_row": F.lit(1), "_p_toxic": F.lit(0.0), "_words": F.lit("w")})
    found = toxicity.score(docs, chain).collect()
    assert sorted(r.toxic for r in found) == [False] * 4 + [True] * 3
    kept = toxicity.without_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6]
    assert toxicity.score(make_docs([]), chain).collect() == []


def test_without_labels(spark, make_docs):
    chain = toxicity.train(make_docs([(1, "a"), (2, None)]), spark.createDataFrame([], LABELS), toxicity.label_categories())
    assert [r.toxic for r in toxicity.score(make_docs([(1, "a"), (2, None)]), chain).collect()] == [False, False]
    one = toxicity.train(make_docs([(1, "a"), (2, "b")]), spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS), toxicity.label_categories())
    assert [r.toxic for r in toxicity.score(make_docs([(1, "a")]), one).collect()] == [False]


def scores(spark, labels, texts, n):
    docs = spark.createDataFrame([(i, f"word{i % 7} plain text " + ("insult again" if i % 5 == 0 else "fine")) for i in range(n)], "doc_id long, text string")
    chain = toxicity.train(docs, spark.createDataFrame(labels, LABELS), toxicity.label_categories())
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.p_low_quality, r.p_toxic) for r in toxicity.score(rows, chain).orderBy("doc_id").collect()]


def test_sizes_behave_alike(spark):
    """The same kinds of texts get the same verdicts from 400 and from 4,000 rows."""
    texts = ["an insult", "word0 plain text fine", "word3 fine", ""]
    found = [scores(spark, [(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(n)], texts, n) for n in (400, 4_000)]
    assert [[t >= 0.5 for _, t in f] for f in found] == [[True, False, False, False]] * 2


def test_partial_and_repeated_labels(spark):
    """A row without one label teaches the other category; labels of one id count once, any yes wins."""
    whole = [(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(400)]
    split = [(i, q, None) for i, q, _ in whole] + [(i, None, t) for i, _, t in whole] + [(i, q, 0) for i, q, _ in whole[:50]] * 3 + [(None, 0, 1)] * 9
    texts = ["an insult", "word0 plain text fine", "fine"]
    found, expected = scores(spark, split, texts, 400), scores(spark, whole, texts, 400)
    assert [p for row in found for p in row] == pytest.approx([p for row in expected for p in row])
    toxic_only = scores(spark, [(i, None, t) for i, _, t in whole], texts, 400)
    assert [p for p, _ in toxic_only] == [0.0] * 3 and [t >= 0.5 for _, t in toxic_only] == [True, False, False]


def test_folds_do_not_see_their_rows(spark, monkeypatch):
    """The second model learns from probabilities of models that were fitted without the row's fold."""
    seen, fit = [], toxicity._fitted
    monkeypatch.setattr(toxicity, "_fitted", lambda learner, rows, category: seen.append((category, rows)) or fit(learner, rows, category))
    scores(spark, [(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(400)], [""], 400)
    assert [c for c, _ in seen] == ["low_quality"] * (1 + toxicity.FOLDS) + ["toxic"]
    folds = [{r[0] for r in rows.select("_fold").distinct().collect()} for _, rows in seen]
    assert folds[1:-1] == [set(range(toxicity.FOLDS)) - {k} for k in range(toxicity.FOLDS)]
    # Each row's probability, again, from a model fitted by hand on the other folds.
    known, learnt = seen[0][1], seen[-1][1]
    for k in range(toxicity.FOLDS):
        model = fit(toxicity._learner("low_quality", [], toxicity.TELLING, toxicity.PENALTY), known.where(F.col("_fold") != k), "low_quality")
        again = {r._key: r._p_low_quality for r in toxicity._scored(model, known.where(F.col("_fold") == k), "low_quality").collect()}
        used = {r._key: r._p_low_quality for r in learnt.where(F.col("_fold") == k).collect()}
        assert used == pytest.approx(again)


def test_query(spark, data):
    from civicpanel.llm.queries import op9_toxicity

    found = op9_toxicity(spark, data).collect()
    assert len(found) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(0 <= r.p_toxic <= 1 and r.toxic == (r.p_toxic >= toxicity.THRESHOLD) for r in found)
