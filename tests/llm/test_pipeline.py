"""The pipeline against brute-force stages, and each stage on awkward documents."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from civicpanel.llm import toxicity

from .test_near_duplicates import brute as brute_components

FOLDER = "/root/testdata/sf0.001"


def cut(rows, length):
    """Texts without the bytes of windows that an earlier document has."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, data in rows:
        for at in range(len(data) - length + 1):
            w = data[at : at + length]
            first[w] = min(first.get(w, i), i)
    for i, data in rows:
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        yield i, bytes(b for b, g in zip(data, gone) if not g).decode(errors="ignore")


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    chain = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), toxicity.label_categories())
    fine = {r.doc_id for r in toxicity.score(docs, chain).collect() if not r.toxic}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in fine]
    kept = {i for i, _, _, stays in brute_components(rows, 5) if stays}
    rows = list(cut([r for r in rows if r[0] in kept], corpus_pipeline.REPEATED_BYTES))
    plain = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff_]+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(w in plain(t) for w in items)]
    tokenizer = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in rows}
    found = {}
    for r in sorted(corpus_pipeline.run(spark, FOLDER).collect(), key=lambda r: r.start):
        found[r.doc_id] = found.get(r.doc_id, b"") + r.ids
    assert found == expected and len(found) > 100


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_awkward_documents(spark, make_docs, name, stage):
    rows = [(1, None), (2, ""), (3, "some plain words that are here twice or so"), (3, "some plain words that are here twice or so"),
            (None, "without an id"), (None, None), (5, "long " * 100_000), (6, "y" * 100_000)]
    docs = make_docs(rows).withColumns({"_row": F.lit(1), "id": F.lit("x"), "length": F.lit(2), "words": F.lit(3)})
    found = stage(spark, docs, FOLDER)
    rows = found.collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, None, 5, 6}
    if name != "packing":
        assert found.columns == docs.columns and [k for _, k in found.dtypes] == [k for _, k in docs.dtypes]
    assert stage(spark, make_docs([]), FOLDER).collect() == []
