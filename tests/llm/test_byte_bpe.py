"""Ids against the tiktoken library, offsets and decoding against exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from civicpanel.llm import byte_bpe as bb
from civicpanel.llm.byte_bpe_query import RANKS, op11_byte_bpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bb.ranks(RANKS), special_tokens={})


def noise(rng, n):
    """Text of all kinds of characters, runs among them."""
    kinds = ["abcdeflmnorst", "ABCÄÖß", "0123456789½", " \t\n 　", ".,;'\"!-_<|>", "日本語中文字", "аебвик", "😀👩‍🚀🇧🇷", "é​\x00\x7f"]
    out = []
    while len(out) < n:
        kind = rng.choice(kinds)
        out += rng.choice(kind) * rng.choice([1, 1, 1, 3, 40]) if rng.random() < 0.2 else rng.choices(kind, k=rng.randint(1, 8))
    return "".join(out)


def test_ids_equal_tiktoken(reference):
    rng = random.Random(1)
    texts = [noise(rng, rng.randint(1, 300)) for _ in range(1500)] + ["", "a" * 5000, " " * 3000, "ab" * 2000, "\n \n" * 900, "é" * 999, "I'll we've 's''s"]
    for text, ids in zip(texts, bb.codec(RANKS, PATTERN).ids(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_pieces_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bb, "PIECE", 50)
    monkeypatch.setattr(bb, "AT_ONCE", 200)
    rng = random.Random(2)
    texts = [noise(rng, 900) + " x  y　 z \n w" * 20 for _ in range(60)] + ["y" * 400, " " * 400]
    assert max(len(bb.pieces(t)) for t in texts) > 3 and all("".join(bb.pieces(t)) == t for t in texts)
    for text, ids in zip(texts, bb.codec(RANKS, PATTERN).ids(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bb, "KEPT_LETTERS", 300)
    monkeypatch.setattr(bb, "AT_ONCE", 200)
    rng = random.Random(6)
    coder, texts = bb.codec(RANKS, PATTERN), [noise(rng, 120) for _ in range(80)]
    assert [i.tolist() for i in coder.ids(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert coder.letters < 900


def test_different_words_are_not_kept():
    """Texts of words that all differ cost no more than others: none is learnt."""
    rng, coder = random.Random(7), bb.codec(RANKS, PATTERN)
    text = " ".join("".join(rng.choices("abcdeéü", k=9)) for _ in range(5000))
    assert coder.bytes.of(coder.ids([text])[0]).tobytes().decode() == text
    assert coder.letters == 0 and "tokenizer" not in vars(coder)


def merged(word, table):
    """Ids of a word by the definition: the neighbours of the lowest rank become one, the first of equals."""
    parts = [bytes([b]) for b in word.encode()]
    while len(parts) > 1:
        rank, at = min((table.get(a + b, len(table) * 2), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(table) * 2:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [table[p] for p in parts]


@pytest.mark.parametrize("at_once", [bb.AT_ONCE, 0])
def test_ids_by_definition(monkeypatch, at_once):
    monkeypatch.setattr(bb, "AT_ONCE", at_once)
    rng, table, coder = random.Random(8), bb.ranks(RANKS), bb.codec(RANKS, PATTERN)
    texts = [noise(rng, 150) for _ in range(100)] + ["<|never|> <|endoftext|>", "a" * 300, ""]
    for text, ids in zip(texts, coder.ids(texts)):
        assert ids.tolist() == [i for word in coder.words_of(text) for i in merged(word, table)]


def test_words_one_by_one(reference, monkeypatch):
    """The way of long unbroken runs, also when it forgets words, gives what the other way does."""
    monkeypatch.setattr(bb, "AT_ONCE", 0)
    monkeypatch.setattr(bb, "KEPT_LETTERS", 300)
    rng = random.Random(9)
    coder, texts = bb.codec(RANKS, PATTERN), [noise(rng, 120) for _ in range(80)]
    assert [i.tolist() for i in coder.ids(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert 0 < coder.letters < 900


def test_every_character_one_by_one(reference, monkeypatch):
    monkeypatch.setattr(bb, "AT_ONCE", 0)
    coder = bb.codec(RANKS, PATTERN)
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}.{c}" for c in every[at : at + 500]) for at in range(0, len(every), 500)]
    assert [i.tolist() for i in coder.ids(texts)] == reference.encode_ordinary_batch(texts, num_threads=8)


def test_more_spaces_than_tiktoken_takes(reference):
    n, coder = 1_100_000, bb.codec(RANKS, PATTERN)
    ids = coder.ids([" " * n + "x", "plain", " " * n])
    assert ids[0].tolist() == ids[2].tolist()[: n - 1] + reference.encode_ordinary(" x")
    assert ids[1].tolist() == reference.encode_ordinary("plain") and coder.bytes.of(ids[2]).tobytes() == b" " * n


def test_every_character_splits_alike(reference):
    """The split pattern means the same to the libraries, for all characters."""
    coder = bb.codec(RANKS, PATTERN)
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}.{c}" for c in every[at : at + 500]) for at in range(0, len(every), 500)]
    expected = reference.encode_ordinary_batch(texts, num_threads=8)
    assert [i.tolist() for i in coder.ids(texts)] == expected


def test_offsets(reference):
    rng = random.Random(3)
    coder = bb.codec(RANKS, PATTERN)
    for text in [noise(rng, 200) for _ in range(100)] + ["", "plain words", "🇧🇷"]:
        ids = coder.ids([text])[0]
        starts, ends, split = coder.offsets(text, ids)
        at, expected = 0, []
        byte_to_char = [i for i, c in enumerate(text) for _ in c.encode()]
        whole = 0
        for token in reference.decode_tokens_bytes(ids.tolist()):
            first, last = byte_to_char[at], byte_to_char[at + len(token) - 1]
            expected.append((first, last + 1))
            whole += text[first : last + 1].encode() == token
            at += len(token)
        assert list(zip(starts.tolist(), ends.tolist())) == expected
        assert split == len(ids) - whole


def test_ids_cut_anywhere_lose_nothing():
    rng = random.Random(4)
    coder, table = bb.codec(RANKS, PATTERN), bb.built(RANKS)[1]
    for _ in range(200):
        text = noise(rng, 60)
        ids, parts = coder.ids([text])[0], []
        while len(ids):
            n = rng.randint(1, 4)
            parts.append(bb.halves(table.of(ids[:n]).tobytes()))
            ids = ids[n:]
        assert b"".join(h + t.encode() + e for h, t, e in parts).decode() == text
        assert all("�" not in t for _, t, _ in parts)


def test_halves():
    assert bb.halves("é".encode()[1:] + b"ab" + "日".encode()[:2]) == ("é".encode()[1:], "ab", "日".encode()[:2])
    assert bb.halves(b"a\xffb") == (b"", "a�b", b"")
    assert bb.halves(b"") == (b"", "", b"")
    assert bb.halves("😀".encode()[1:]) == ("😀".encode()[1:], "", b"")


ROWS = [(1, "Olá, mundo 😀"), (1, "Olá, mundo 😀"), (2, None), (3, ""), (None, "no id"), (4, "word " * 100_000), (5, "x" * 30_000), (6, "<|endoftext|> 's")]


def test_awkward_rows(make_docs, reference):
    docs = make_docs(ROWS).withColumns({"ids": F.lit("x"), "bytes": F.lit(1), "_given": F.lit(2)}).drop("_given")
    found = bb.encode(docs, RANKS, PATTERN)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "bytes", "ids", "starts", "ends", "split_tokens"]
    back = bb.decode(found, RANKS).collect()
    expected = sorted((str(i), t or "") for i, t in ROWS)
    assert sorted((str(r.doc_id), r.text) for r in back) == expected
    assert all(bytes(r.bytes).decode() == r.text and not r.head and not r.tail and r.unknown_ids == 0 for r in back)
    ids = sorted((str(r.doc_id), r.ids) for r in found.collect())
    assert ids == sorted((str(i), reference.encode_ordinary(t or "")) for i, t in ROWS)
    assert bb.encode(make_docs([]), RANKS, PATTERN).collect() == []


def test_decoding_of_odd_ids(spark, reference):
    ids = reference.encode_ordinary("dia 🇧🇷")
    rows = [(1, ids), (2, None), (3, []), (4, [-5, ids[0], 10**6, None]), (5, ids[2:]), (6, ids[:-1])]
    found = {r.k: r for r in bb.decode(spark.createDataFrame(rows, "k int, ids array<int>"), RANKS).collect()}
    assert (found[2].bytes, found[2].text, found[3].text) == (None, None, "")
    assert (found[4].text, found[4].unknown_ids) == (reference.decode(ids[:1]), 3)
    assert bytes(found[6].head + found[6].text.encode() + found[6].tail) == reference.decode_bytes(ids[:-1])


def test_query(spark, data, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = op11_byte_bpe(spark, data).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
