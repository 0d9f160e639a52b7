"""Word-piece lengths of texts by a linear longest-match automaton.

Greedy longest match reads a word left to right and takes the longest piece of the
vocabulary each time. The automaton gets the same count in one pass over the characters:
a trie of the vocabulary in which every node knows how many pieces the greedy match has
certainly taken once the next character does not continue the node (``pops``) and the node
that holds what is left over (``fail``). No piece is built and no character read twice, so
a word of a million characters costs a million steps.

A text is split at white space, as ``str.split`` does. A character without any piece counts
as its UTF-8 bytes (``unknown="bytes"``), or makes its whole word one token (``"word"``).
NULL and empty texts have no words and no tokens; every row gives a row, repeated ids too.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.common import small_batches, text_or_empty

#: Marks a popped character without a piece, above any count.
UNKNOWN = 1 << 48
#: Distinct words remembered by one task, so that frequent words are matched once.
REMEMBERED = 500_000

COUNTS = "doc_id long, n_words long, n_tokens long"


class LongestMatch:
    """The automaton. ``initial`` pieces begin a word, ``inner`` pieces continue it (None: the same)."""

    def __init__(self, initial: Iterable[str], inner: Iterable[str] | None = None):
        self.next: list[dict[str, int]] = [{}]
        self.pops = [0]
        self.fail = [0]
        tokens = self._insert(0, initial)
        self.start, self.rest = 0, 0
        if inner is not None:
            self.rest = self._node()
            tokens |= self._insert(self.rest, inner)
            self.fail[0] = self.rest
        self._link(tokens)

    def _node(self) -> int:
        self.next.append({})
        self.pops.append(0)
        self.fail.append(0)
        return len(self.next) - 1

    def _insert(self, root: int, pieces: Iterable[str]) -> set[int]:
        ends = set()
        for piece in pieces:
            node = root
            for c in piece:
                if c not in self.next[node]:
                    child = self._node()
                    self.next[node][c] = child
                node = self.next[node][c]
            if node != root:
                ends.add(node)
        return ends

    def _link(self, tokens: set[int]) -> None:
        """Breadth first: what a node pops and where it goes follows from its parent."""
        queue = deque([self.start] if self.start == self.rest else [self.start, self.rest])
        roots = {self.start, self.rest}
        while queue:
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                if node in tokens:
                    self.pops[node], self.fail[node] = 1, self.rest
                elif parent in roots:
                    self.pops[node], self.fail[node] = UNKNOWN + len(c.encode()), self.rest
                else:
                    popped, at = self.pops[parent], self.fail[parent]
                    while c not in self.next[at] and at != self.rest:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if c in self.next[at]:
                        self.pops[node], self.fail[node] = popped, self.next[at][c]
                    else:
                        self.pops[node], self.fail[node] = popped + UNKNOWN + len(c.encode()), self.rest
                queue.append(node)

    def length(self, word: str) -> int:
        """Greedy tokens of ``word``, plus ``UNKNOWN`` for each character that has no piece."""
        children, pops, fail, rest = self.next, self.pops, self.fail, self.rest
        node, total = self.start, 0
        for c in word:
            while c not in children[node]:
                if node in (rest, self.start):
                    total += UNKNOWN + len(c.encode())
                    node = rest
                    break
                total += pops[node]
                node = fail[node]
            else:
                node = children[node][c]
        while node not in (rest, self.start):
            total += pops[node]
            node = fail[node]
        return total


class WordLengths(dict):
    """Length of each word met so far; forgets all of them when there are too many."""

    def __init__(self, automaton: LongestMatch, prefix: str, unknown: str):
        super().__init__()
        self.automaton, self.prefix, self.whole = automaton, prefix, unknown == "word"

    def __missing__(self, word: str) -> int:
        found = self.automaton.length(self.prefix + word)
        count = 1 if self.whole and found >= UNKNOWN else found % UNKNOWN
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count


def sentencepiece_pieces(path: str) -> tuple[list[str], None]:
    """Pieces of a sentencepiece model: "▁" is an ordinary character that begins a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))], None


def marked_pieces(pieces: Iterable[str], mark: str = "##") -> tuple[list[str], list[str]]:
    """Pieces of a vocabulary whose inner pieces carry a mark: (initial, inner)."""
    pieces = list(pieces)
    return [p for p in pieces if not p.startswith(mark)], [p[len(mark) :] for p in pieces if p.startswith(mark)]


def token_counts(
    docs: DataFrame, initial: list[str], inner: list[str] | None = None, prefix: str = "", unknown: str = "bytes"
) -> DataFrame:
    """Words and greedy word pieces of every text; ``prefix`` is put before each word."""
    if unknown not in ("bytes", "word"):
        raise ValueError("unknown must be 'bytes' or 'word'")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths = WordLengths(LongestMatch(initial, inner), prefix, unknown)
        for batch in batches:
            words = [text.split() for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_words": [len(w) for w in words],
                    "n_tokens": [sum(map(lengths.__getitem__, w)) for w in words],
                }
            )

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(count, COUNTS)
