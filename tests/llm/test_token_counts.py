"""The automaton against a greedy match that tries every length."""

import random

import public_tokenizers
import pytest

from civicpanel.llm import token_counts as tc


def greedy(word, initial, inner, unknown):
    count, at, missing = 0, 0, False
    while at < len(word):
        pieces = initial if at == 0 else inner
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in pieces), 0)
        missing |= not size
        count += 1 if size else len(word[at].encode())
        at += size or 1
    return 1 if missing and unknown == "word" else count


@pytest.mark.parametrize("marked", [False, True])
@pytest.mark.parametrize("unknown", ["bytes", "word"])
def test_equals_greedy(marked, unknown):
    rng = random.Random(3)
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "aé日b"])
        words = lambda n, size: {"".join(rng.choice(letters) for _ in range(rng.randint(1, size))) for _ in range(n)}
        initial = words(rng.randint(1, 9), 6)
        inner = words(rng.randint(1, 9), 6) if marked else None
        lengths = tc.WordLengths(tc.LongestMatch(initial, inner), "", unknown)
        for word in words(30, 14) | {"abcz", "zzz"}:
            assert lengths[word] == greedy(word, initial, inner if marked else initial, unknown), (word, initial, inner)


def test_marked_vocabulary():
    initial, inner = tc.marked_pieces(["a", "abcdx", "##b", "##c", "##cdy", "##dz"])
    automaton = tc.LongestMatch(initial, inner)
    assert automaton.length("abcdz") == 4


def test_awkward_documents(make_docs):
    initial, inner = tc.sentencepiece_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "the cat"), (4, "the cat"), (None, "é" * 300_000), (6, "the " * 50_000)]
    found = sorted(map(tuple, tc.token_counts(make_docs(rows), initial, inner, "▁").collect()), key=str)
    by_id = {r[0]: r[1:] for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == (0, 0)
    assert by_id[4] == (2, 2) and len(found) == 7
    assert by_id[6] == (50_000, 50_000) and by_id[None][0] == 1
    assert tc.token_counts(make_docs([]), initial, inner, "▁").collect() == []


def test_query_equals_greedy(spark, data):
    from civicpanel.llm.queries import op2_token_counts

    pieces = set(tc.sentencepiece_pieces(public_tokenizers.path("piece_bpe_32k.model"))[0])
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = op2_token_counts(spark, data).collect()
    assert len(found) == len(texts)
    for r in found:
        words = texts[r.doc_id].split()
        assert r.n_words == len(words)
        if len(words) < 300:
            assert r.n_tokens == sum(greedy("▁" + w, pieces, pieces, "bytes") for w in words)
