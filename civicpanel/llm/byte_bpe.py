"""Byte-level BPE: texts to ids with offsets, and ids back to bytes and text.

Encoding runs in the ``tiktoken`` library over Arrow batches, at a cost that does not depend on
how many different words there are. Long texts are encoded in pieces of about ``PIECE`` characters,
cut where a space follows something that is not white space: there every match of the split
pattern ends, so nothing changes. The offsets of a token count the bytes of the tokens before
it; they are turned into characters by the bytes that begin one. A token that holds part of a
character has the span of the whole character, so spans of neighbours can overlap.

tiktoken's pattern matcher gives up on runs of about a million white spaces. A piece that cannot
be cut to ``AT_ONCE`` characters is split by the ``regex`` library and its words go to ``tokenizers``.
There a byte-level vocabulary writes each byte as a printable character; ranks become a vocabulary
and the merges that make each token out of two shorter ones, and matches of the split pattern
that are a token are taken whole. A match has the same ids wherever it stands, so each different
one is encoded once for as long as a task keeps it. The pattern's classes are those of tiktoken:
characters that ``regex``'s Unicode tables class otherwise are found by probing both and stand for a
plain one of their class in splitting.

Decoding reverses the byte table. Ids may begin or end inside a character, as pieces of a
packed document do: ``head`` and ``tail`` are the bytes of its other half, and ``text`` is what
lies between; heads and tails joined in order lose nothing. Bytes that are no UTF-8 inside a
text become U+FFFD there and stay in ``bytes``. Ids that the vocabulary lacks give no bytes and
are counted.

NULL and empty texts have no ids, a NULL array of ids no bytes. Each row is worked on by itself,
repeated ids and rows too. The results take the place of the column read; other columns are
kept, but one that is named like a result is replaced.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicpanel.llm.common import small_batches
from civicpanel.llm.packing import byte_alphabet

#: Characters of a piece of a long text, and the most that ``tiktoken`` gets at once.
PIECE, AT_ONCE = 1 << 18, 1 << 19
#: Characters of the words whose ids a task keeps; beyond, it begins anew.
KEPT_LETTERS = 1 << 23

#: Name of the column that is read, inside a job.
GIVEN = "_given"
LETTERS = {byte: letter for letter, byte in byte_alphabet().items()}


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merges(vocabulary: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All ways to make a token out of two, in the order of the tokens made."""
    return [
        (token[:i], token[i:])
        for token, _ in sorted(vocabulary.items(), key=lambda x: x[1])
        for i in range(1, len(token))
        if token[:i] in vocabulary and token[i:] in vocabulary
    ]


class Bytes:
    """The byte table: characters to bytes, and the bytes of every id."""

    def __init__(self, vocabulary: dict[str, int]):
        table = byte_alphabet()
        tokens = {i: bytes(table[c] for c in token) for token, i in vocabulary.items()}
        lengths = np.zeros(max(tokens, default=-1) + 2, np.int64)
        for i, token in tokens.items():
            lengths[i] = len(token)
        self.known = np.zeros(len(lengths), bool)
        self.known[list(tokens)] = True
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids one after the other; unknown ids have none."""
        ids = np.where((ids >= 0) & (ids < len(self.lengths)), ids, len(self.lengths) - 1)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.arange(total) + np.repeat(self.starts[ids] - ends + lengths, lengths)]

    def unknown(self, ids: np.ndarray) -> int:
        inside = (ids >= 0) & (ids < len(self.lengths))
        return int((~inside).sum() + (~self.known[ids[inside]]).sum())


class Codec:
    """A vocabulary in ``tiktoken``, and in ``tokenizers`` for long unbroken runs with the ids of their words seen so far."""

    def __init__(self, table: dict[bytes, int], built: str, bytes_of: Bytes, odd: dict[int, str], pattern: str):
        import regex
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        # Arrays take half as long again from a vocabulary without a special token; this one is never allowed, so never an id.
        never = {"<|never|>": max(table.values(), default=-1) + 1}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=never)
        self.built, self.bytes, self.pattern = built, bytes_of, regex.compile(pattern)
        self.odd, self.has_odd = odd, re.compile(one_of(odd)).search if odd else None
        self.forget()

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.built)

    def words_of(self, text: str) -> list[str]:
        """Matches of the split pattern, characters classed as tiktoken does."""
        if text.isascii() or self.has_odd is None or not self.has_odd(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.odd))]

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.letters = self.filled = 0
        self.flat, self.starts, self.lengths = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def learn(self, words: list[str]) -> None:
        """Encode words that were not seen before."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        at, end, total = len(self.index), len(self.index) + len(words), int(lengths.sum())
        self.index.update(zip(words, range(at, end)))
        self.starts, self.lengths = roomy(self.starts, end), roomy(self.lengths, end)
        self.starts[at:end], self.lengths[at:end] = self.filled + np.cumsum(lengths) - lengths, lengths
        self.flat = roomy(self.flat, self.filled + total)
        self.flat[self.filled : self.filled + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        self.filled += total
        self.letters += sum(map(len, words))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.concatenate([np.zeros(0, np.int32), *map(self.ids_of_piece, pieces(text))]) for text in texts]

    def ids_of_piece(self, text: str) -> np.ndarray:
        if len(text) > AT_ONCE:
            return self.ids_of_words(self.words_of(text))
        return self.fast.encode_to_numpy(text, disallowed_special=()).view(np.int32)

    def ids_of_words(self, words: list[str]) -> np.ndarray:
        """Ids of words one after the other; those not kept from earlier are encoded first."""
        if self.letters > KEPT_LETTERS:
            self.forget()
        if new := set(words).difference(self.index):
            self.learn(list(new))
        place = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[place] - ends + lengths, lengths)]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """First and last character (exclusive) of each token, and how many hold part of a character."""
        begins = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(begins)])  # characters that begin before each byte
        ends = np.cumsum(self.bytes.lengths[ids])
        starts = ends - self.bytes.lengths[ids]
        inside = np.concatenate([~begins, [False]])
        first = before[starts] - inside[starts]
        return first.astype(np.int32), before[ends].astype(np.int32), int((inside[starts] | inside[ends]).sum())


def odd_characters() -> dict[int, str]:
    """Characters that ``regex`` and tiktoken class otherwise, as their Unicode tables are of different years.

    With each a plain character of the class that tiktoken sees: white space, number, letter or other.
    """
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    odd, classes = set(), {}
    for kind, plain in ((r"\s", "\u2003"), (r"\p{N}", "0"), (r"\p{L}", "é")):
        # What tiktoken does not match has no ids.
        probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(probe.encode_ordinary(every)).decode())
        odd |= theirs.symmetric_difference(regex.findall(kind, every))
        classes |= dict.fromkeys(theirs, plain)
    return {ord(c): classes.get(c, "!") for c in odd}


def one_of(characters: dict[int, str]) -> str:
    """A pattern for any of the characters, as ranges."""
    ranges: list[list[int]] = []
    for c in sorted(characters):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


def built(path: str) -> tuple[str, Bytes, dict[int, str]]:
    """What a ``Codec`` needs besides ranks: the tokenizer as text, the byte table, odd characters.

    Words come split already, so the tokenizer splits no more.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    table = ranks(path)
    vocabulary = {written_as(token): i for token, i in table.items()}
    pairs = [(written_as(a), written_as(b)) for a, b in merges(table)]
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=pairs, ignore_merges=True, cache_capacity=0))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer.to_str(), Bytes(vocabulary), odd_characters()


def codec(path: str, pattern: str) -> Codec:
    return Codec(ranks(path), *built(path), pattern)


def roomy(values: np.ndarray, size: int) -> np.ndarray:
    """The same numbers with room for ``size`` of them."""
    if size <= len(values):
        return values
    grown = np.zeros(2 * size, values.dtype)
    grown[: len(values)] = values
    return grown


def written_as(token: bytes) -> str:
    return "".join(LETTERS[b] for b in token)


def pieces(text: str) -> list[str]:
    """A text cut before spaces that follow something that is not white space, about every ``PIECE`` characters."""
    found, at = [], 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut != -1 and (text[cut] != " " or text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        found.append(text[at:cut])
        at = cut
    return [*found, text[at:]] if len(text) > at else found


def arrays(parts: list[np.ndarray]) -> pa.Array:
    """Arrays of whole numbers as one Arrow list column."""
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([np.zeros(0, np.int32), *parts])
    return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``ids``, ``starts``, ``ends`` (arrays of int) and ``split_tokens``, those with part of a character, for a text column."""
    results = ["ids", "starts", "ends", "split_tokens"]
    kept = [c for c in docs.columns if c not in (column, *results)]
    vocabulary = ranks(path), *built(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codec(*vocabulary, pattern)
        for batch in batches:
            texts = [t or "" for t in batch[GIVEN].to_pylist()]
            ids = coder.ids(texts)
            spans = [coder.offsets(t, i) for t, i in zip(texts, ids)]
            lists = [arrays(ids), arrays([s[0] for s in spans]), arrays([s[1] for s in spans])]
            split = pa.array([s[2] for s in spans], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *lists, split], names=[*kept, *results])

    small_batches(docs.sparkSession)
    schema = StructType([*docs.select(*kept).schema, *StructType.fromDDL("ids array<int>, starts array<int>, ends array<int>, split_tokens int")])
    return docs.select(*kept, F.col(column).cast("string").alias(GIVEN)).mapInArrow(run, schema)


def halves(data: bytes) -> tuple[bytes, str, bytes]:
    """Bytes of a character that began earlier, the text, and bytes of one that ends later."""
    begin = 0
    while begin < min(3, len(data)) and data[begin] & 0xC0 == 0x80:
        begin += 1
    end = len(data)
    for back in range(1, min(3, len(data) - begin) + 1):
        byte = data[-back]
        if byte & 0xC0 != 0x80:
            needs = 4 if 0xF0 <= byte < 0xF5 else 3 if 0xE0 <= byte < 0xF0 else 2 if 0xC2 <= byte < 0xE0 else 1
            end = len(data) - back if needs > back else end
            break
    return data[:begin], data[begin:end].decode("utf-8", "replace"), data[end:]


def decode(encoded: DataFrame, path: str, column: str = "ids", texts: bool = True) -> DataFrame:
    """``bytes``, ``unknown_ids`` and, if asked for, ``head``, ``text`` and ``tail`` for an array of ids."""
    results = StructType.fromDDL("bytes binary, unknown_ids int" + (", head binary, text string, tail binary" if texts else ""))
    kept = [c for c in encoded.columns if c != column and c not in results.names]
    names = [*kept, *results.names]
    table = Bytes({written_as(token): i for token, i in ranks(path).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch[GIVEN]
            flat, ends = given.flatten().fill_null(-1).to_numpy(), np.cumsum(given.value_lengths().fill_null(0).to_numpy())
            each = np.split(flat, ends[:-1]) if len(batch) else []
            missing = given.is_null().to_pylist()
            data = [None if gone else table.of(ids).tobytes() for ids, gone in zip(each, missing)]
            made = [pa.array(data, pa.binary()), pa.array([table.unknown(ids) for ids in each], pa.int32())]
            if texts:
                parts = [(None, None, None) if d is None else halves(d) for d in data]
                made += [pa.array([p[i] for p in parts], kind) for i, kind in enumerate((pa.binary(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *made], names=names)

    small_batches(encoded.sparkSession)
    schema = StructType([*encoded.select(*kept).schema, *results])
    return encoded.select(*kept, F.col(column).cast("array<int>").alias(GIVEN)).mapInArrow(run, schema)
