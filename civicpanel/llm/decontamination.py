"""Benchmark passages in documents by latent semantic retrieval, verified by common subsequences.

1.  Benchmark items are cut into passages of at most ``LONGEST`` words. Their terms are the
    vocabulary, weighted by inverse document frequency counted over all documents in one pass.
    No term weighs less than ``LEAST``, so passages of frequent words, or copied into most of
    the documents, are found like others.
2.  A randomised SVD of the TF-IDF passages, its products as Spark jobs, finds one latent space
    for the benchmark, of at most ``RANK`` dimensions and half as many as there are passages.
    What reaches the driver is as large as the vocabulary of a block of the benchmark.
3.  Every document is read once, in overlapping windows of about the length of the passages.
    A window is a candidate if the cosine of both in the space is ``COSINE`` and its projection
    covers ``COVER`` of the passage's length; both are much looser than the check, so words
    replaced by others or put in between hide nothing. What chance has brought close in the
    few dimensions goes by its own words: they must have ``SHARED`` of the passage's weight.
4.  The words around a candidate window are compared with the passage by their longest common
    subsequence: a passage is found if ``VERBATIM`` of its words are there in order, or if
    ``PARAPHRASE`` are and so is ``ANSWER`` of its last quarter, where the answer stands.
    Passages of fewer than ``SHORT`` words must be there in full.

The benchmark is the stated query set. Up to ``BLOCK`` passages take one pass for the document
frequencies and one scan; what is broadcast is as large as their vocabulary times the rank, and
bounded by the block. Words are lower-cased runs of letters and digits, punctuation does not
count. NULL and empty texts and items contain and match nothing. Each row is judged by itself,
repeated ids and rows too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.common import RunHashes, bytes_of, small_batches, text_or_empty
from civicpanel.llm.fingerprints import TERM_BYTES

LONGEST = 96
#: Window sizes, each twice the one before; a passage is searched with the smallest that holds it. Windows advance by a third.
WINDOWS = (24, 48, LONGEST)
#: Passages of one search.
BLOCK = 1 << 14
RANK, EXTRA, POWER = 64, 32, 2
#: Weight of a term that is in every document.
LEAST = 0.05
COSINE, COVER, SHARED = 0.45, 0.25, 0.15
VERBATIM, PARAPHRASE, ANSWER = 0.7, 0.5, 0.8
SHORT = 8
#: Occurrences of terms that are added up at once, and windows that are compared at once.
CHUNK, TILE = 1024, 4096
GAP = 2 * LONGEST

HITS = "doc_id long, item_id long, cosine double, common double, answer double"


class Words:
    """Hashes of the words of many texts, with their position; texts are far apart."""

    def __init__(self, texts: list[str], hashes: RunHashes):
        each = [hashes(bytes_of(t.lower())) for t in texts]
        counts = np.array([len(e) for e in each], int)
        self.hashes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.row = np.repeat(np.arange(len(texts)), counts)
        self.position = np.arange(len(self.hashes)) + self.row * GAP


@dataclass
class Passages:
    """Benchmark passages and, once trained, their latent space."""

    item: np.ndarray
    words: list[np.ndarray]
    vocabulary: np.ndarray
    weight: np.ndarray | None = None
    space: np.ndarray | None = None

    def terms(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are in the vocabulary, and their index there."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == hashes)
        return known, at[known]


def blocks_of(benchmark: DataFrame) -> Iterator[Passages]:
    """Benchmark passages in blocks. The driver holds one block at a time."""
    hashes, item, words = RunHashes(TERM_BYTES), [], []
    ordered = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).orderBy("item_id", "text")

    def block() -> Passages:
        return Passages(np.array(item, object), list(words), np.unique(np.concatenate(words)))

    for row in ordered.toLocalIterator():
        found = hashes(bytes_of(row["text"].lower()))
        for at in range(0, len(found), LONGEST):
            if at and len(found) - at < SHORT:
                continue
            item.append(row["item_id"])
            words.append(found[at : at + LONGEST])
            if len(words) == BLOCK:
                yield block()
                item, words = [], []
    if words:
        yield block()


def with_weights(docs: DataFrame, block: Passages) -> Passages:
    """Inverse document frequencies of the block's terms over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen, rows, size = RunHashes(TERM_BYTES), np.zeros(len(block.vocabulary), np.int64), 0, len(block.vocabulary)
        for batch in batches:
            words = Words(list(batch["text"]), hashes)
            known, index = block.terms(words.hashes)
            pairs = np.unique(words.row[known] * size + index)
            seen += np.bincount(pairs % size, minlength=size)
            rows += len(batch)
        yield pd.DataFrame({"term": np.append(np.arange(size), -1), "n": np.append(seen, rows)})

    small_batches(docs.sparkSession)
    counted = docs.select(text_or_empty().alias("text")).mapInPandas(count, "term int, n long")
    sums = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    total = sums.get(-1, 0)
    seen = np.array([sums.get(t, 0) for t in range(len(block.vocabulary))])
    block.weight = np.maximum(np.log((1 + total) / (1 + seen)), LEAST)
    return block


def passage_rows(docs: DataFrame, block: Passages) -> DataFrame:
    """TF-IDF rows (terms, values) of unit length, one for each passage."""

    def unit(hashes: np.ndarray) -> tuple[bytearray, bytearray]:
        _, index = block.terms(hashes)
        terms, counts = np.unique(index, return_counts=True)
        values = counts * block.weight[terms]
        return bytearray(terms.astype(np.int32).tobytes()), bytearray((values / max(np.linalg.norm(values), 1e-12)).tobytes())

    return docs.sparkSession.createDataFrame([unit(w) for w in block.words], "terms binary, values binary")


def products(rows: DataFrame, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A'(A B) and (A B)'(A B) for the passages A and a basis B, summed over tasks by Spark."""
    wide, terms = basis.shape[1], basis.shape[0]
    step = 256

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back, inner = np.zeros(basis.shape), np.zeros((wide, wide))
        for batch in batches:
            for t, v in zip(batch["terms"], batch["values"]):
                index, values = np.frombuffer(t, np.int32), np.frombuffer(v)
                line = values @ basis[index]
                back[index] += values[:, None] * line
                inner += np.outer(line, line)
        parts = [("back", at, back[at : at + step]) for at in range(0, terms, step)]
        parts += [("inner", at, inner[at : at + step]) for at in range(0, wide, step)]
        yield pd.DataFrame([(kind, at, p.tobytes()) for kind, at, p in parts], columns=["kind", "at", "part"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p) for p in group["part"])
        return pd.DataFrame({"kind": group["kind"].iloc[:1], "at": group["at"].iloc[:1], "part": [total.tobytes()]})

    schema = "kind string, at int, part binary"
    found = rows.mapInPandas(multiply, schema).groupBy("kind", "at").applyInPandas(add, schema).collect()
    made = {}
    for kind in ("back", "inner"):
        parts = sorted((r["at"], r["part"]) for r in found if r["kind"] == kind)
        made[kind] = np.concatenate([np.frombuffer(p).reshape(-1, wide) for _, p in parts])
    return made["back"], made["inner"]


def with_space(docs: DataFrame, block: Passages, seed: int = 0) -> Passages:
    """Right singular vectors of the passages, by power iterations on a random start."""
    rows, size = passage_rows(docs, block), len(block.vocabulary)
    rank = min(RANK, -(-len(block.words) // 2))
    wide = min(size, len(block.words), rank + EXTRA)
    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, wide)))
    for _ in range(POWER):
        back, _ = products(rows, basis)
        basis, _ = np.linalg.qr(back)
    _, inner = products(rows, basis)
    values, vectors = np.linalg.eigh(inner)
    block.space = (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)
    return block


class Subsequence:
    """Longest common subsequences with one passage, whose places are the bits of a number."""

    def __init__(self, passage: np.ndarray):
        self.length, self.places = len(passage), {}
        for i, w in enumerate(passage.tolist()):
            self.places[w] = self.places.get(w, 0) | 1 << i

    def places_in(self, region: np.ndarray) -> list[int]:
        """Where the passage has each word of the region that it has at all."""
        places = self.places
        return [places[w] for w in region.tolist() if w in places]

    def most(self, hits: list[int]) -> int:
        """No subsequence is longer than the places that are met at all."""
        met = 0
        for hit in hits:
            met |= hit
        return met.bit_count()

    def longest(self, hits: list[int], first: int = 0) -> int:
        """Length of the longest common subsequence with the passage from place ``first`` on."""
        every = (1 << self.length - first) - 1
        row = every
        for hit in hits:
            hit = row & (hit >> first)
            row = ((row + hit) | (row - hit)) & every
        return self.length - first - row.bit_count()


def common_words(passage: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    whole = Subsequence(passage)
    return whole.longest(whole.places_in(region))


class Scanner:
    """Finds the passages of a trained block in texts."""

    def __init__(self, block: Passages):
        self.block, self.hashes = block, RunHashes(TERM_BYTES)
        self.passages: dict[int, Subsequence] = {}
        self.spread = (block.weight[:, None] * block.space).astype(np.float32)
        # Of every term of every passage: its key, and the share of the passage's weight it stands for.
        size, keys, shares, latent = len(block.vocabulary), [], [], []
        for i, words in enumerate(block.words):
            terms, counts = np.unique(block.terms(words)[1], return_counts=True)
            weights = counts * block.weight[terms] ** 2
            keys.append(i * size + terms)
            shares.append(weights / max(weights.sum(), 1e-12))
            latent.append((counts @ self.spread[terms]))
        self.keys, self.shares = np.concatenate(keys), np.concatenate(shares)
        latent = np.array(latent, np.float32)
        norms = np.maximum(np.linalg.norm(latent, axis=1), 1e-9)
        sizes = np.searchsorted(WINDOWS, [len(w) for w in block.words])
        self.groups = {}
        for i, window in enumerate(WINDOWS):
            members = np.flatnonzero(sizes == i)
            if len(members):
                units = np.ascontiguousarray((latent[members] / norms[members, None]).T)
                self.groups[window] = (window, members, units, norms[members])

    def _steps(self, where: np.ndarray, index: np.ndarray) -> Iterator[np.ndarray]:
        """Latent sums of the stretches of one step, for the steps of all windows; each step is twice the one before."""
        place = where // (WINDOWS[0] // 3)
        unit = 1 << len(WINDOWS)
        sums = np.zeros((-(-(int(place[-1]) + 1) // unit) * unit + 2 * unit, self.spread.shape[1]), np.float32)
        for at in range(0, len(place), CHUNK):
            some = place[at : at + CHUNK]
            first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
            sums[some[first]] += np.add.reduceat(self.spread[index[at : at + CHUNK]], first, axis=0)
        for _ in WINDOWS:
            yield sums
            sums = sums[::2] + sums[1::2]

    def _shared(self, index: np.ndarray, low: np.ndarray, high: np.ndarray, passages: np.ndarray) -> np.ndarray:
        """Share of the weight of each passage that the terms from ``low`` to ``high`` have, each term once per occurrence."""
        counts = high - low
        ends = np.cumsum(counts)
        at = np.arange(int(ends[-1])) + np.repeat(low - ends + counts, counts)
        wanted = np.repeat(passages, counts) * len(self.block.vocabulary) + index[at]
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        share = np.where(self.keys[place] == wanted, self.shares[place], 0.0)
        return np.add.reduceat(share, ends - counts)

    def _candidates(self, where: np.ndarray, index: np.ndarray, sums: np.ndarray, group: tuple) -> Iterator[tuple[int, int, int]]:
        """(first and last known word, passage) of windows whose words are to be compared."""
        size, members, units, norms = group
        step = size // 3
        latent = sums[:-2] + sums[1:-1] + sums[2:]
        lengths = np.linalg.norm(latent, axis=1)
        # Rounding makes a length that is not quite zero of nothing.
        filled = np.flatnonzero(lengths >= COVER * norms.min() - 1e-6)
        for at in range(0, len(filled), TILE):
            some = filled[at : at + TILE]
            along = latent[some] @ units
            near = (along >= COSINE * lengths[some, None] - 1e-6) & (along >= COVER * norms - 1e-6)
            window, column = np.nonzero(near)
            if not len(window):
                continue
            starts = some[window] * step
            low, high = np.searchsorted(where, starts), np.searchsorted(where, starts + size)
            there = np.flatnonzero(high > low)
            low, high, passages = low[there], high[there], members[column[there]]
            if len(low):
                for i in np.flatnonzero(self._shared(index, low, high, passages) >= SHARED):
                    yield int(low[i]), int(high[i]), int(passages[i])

    def __call__(self, texts: list[str]) -> list[tuple[int, int, float, float, float]]:
        """(row, passage, cosine, common share, answer share) of what is found, the best per row and passage."""
        words = Words(texts, self.hashes)
        known, index = self.block.terms(words.hashes)
        where = words.position[known]
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        if len(known):
            for window, sums in zip(WINDOWS, self._steps(where, index)):
                if window in self.groups:
                    for low, high, passage in self._candidates(where, index, sums, self.groups[window]):
                        self._verify(words, index, known, low, high, window, passage, best)
        return [(row, passage, *found) for (row, passage), found in best.items()]

    def _verify(self, words: Words, index, known, low: int, high: int, size: int, passage: int, best: dict) -> None:
        row = int(words.row[known[low]])
        if best.get((row, passage), (0, 0.0))[1] == 1.0:
            return
        target = self.block.words[passage]
        start = max(words.first[row], known[low] - size - len(target))
        end = min(words.first[row + 1], known[high - 1] + 1 + size + len(target))
        if passage not in self.passages:
            self.passages[passage] = Subsequence(self.block.terms(target)[1])
        whole, last = self.passages[passage], max(1, len(target) // 4)
        # Every word of the passage is a term, so the terms of the region are all that can be common.
        hits = whole.places_in(index[np.searchsorted(known, start) : np.searchsorted(known, end)])
        if whole.most(hits) < PARAPHRASE * len(target):
            return
        common = whole.longest(hits) / len(target)
        answer = whole.longest(hits, len(target) - last) / last
        found = common == 1.0 if len(target) < SHORT else common >= VERBATIM or (common >= PARAPHRASE and answer >= ANSWER)
        if found and common > best.get((row, passage), (0, 0.0))[1]:
            latent = self.spread[index[low:high]].sum(axis=0)
            own = self.spread[self.block.terms(target)[1]].sum(axis=0)
            cosine = float(latent @ own / max(np.linalg.norm(latent) * np.linalg.norm(own), 1e-9))
            best[row, passage] = (cosine, common, answer)


def trained_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Passages]:
    for block in blocks_of(benchmark):
        yield with_space(docs, with_weights(docs, block))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer): the benchmark items found in each document."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = docs.sparkSession.createDataFrame([], HITS)
    for block in trained_blocks(docs, benchmark):

        def scan(batches: Iterator[pd.DataFrame], block: Passages = block) -> Iterator[pd.DataFrame]:
            scanner = Scanner(block)
            for batch in batches:
                ids = batch["doc_id"].astype("Int64").tolist()
                best: dict[tuple[int, int], tuple] = {}
                for row, passage, *figures in scanner(list(batch["text"])):
                    key = (row, block.item[passage])
                    best[key] = max(best.get(key, ()), tuple(figures), key=lambda f: f[1:2])
                rows = [(ids[row], item, *figures) for (row, item), figures in best.items()]
                made = pd.DataFrame(rows, columns=[c.split()[0] for c in HITS.split(", ")])
                yield made.assign(doc_id=made["doc_id"].astype("Int64"), item_id=made["item_id"].astype("Int64"))

        found = found.union(narrow.mapInPandas(scan, HITS))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, columns as they are."""
    small_batches(docs.sparkSession)
    kept = docs
    for block in trained_blocks(docs, benchmark):
        kept = kept.where(_clean(block)(text_or_empty()))
    return kept


def _clean(block: Passages):
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(block)
        for batch in texts:
            flags = np.ones(len(batch), bool)
            flags[[row for row, *_ in scanner(list(batch))]] = False
            yield pd.Series(flags)

    return clean
