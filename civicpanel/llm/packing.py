"""Packing of token sequences into fixed windows by best-fit decreasing.

Documents are tokenised and cut into full windows and one remainder. Pieces of one length
are alike, so the best fit of all of them follows from how many there are of each length:
at most one count per length reaches the driver, a segment tree over remaining capacities
places them in descending order of length, and the answer is a short list of runs ("the
next n pieces of this length go to these windows"). Its size depends on the window and not
on the corpus. Pieces get their rank among those of their length from the task that cut
them plus a running sum over tasks, so no length, however common, meets in one task.

A NULL or empty text is a document of the end token alone. Rows with the same or a NULL
document id are packed as documents of their own. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicpanel.llm.common import small_batches, text_or_empty, written

WINDOW = 2048
END_ID = 1
#: Longer runs with or without white space are left to the ``tokenizers`` library, whose merge is not quadratic.
LONG_WORD = 2000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_length", T.LongType()),
        T.StructField("first_rank", T.LongType()),
        T.StructField("pieces", T.LongType()),
        T.StructField("per_window", T.LongType()),
        T.StructField("first_window", T.LongType()),
        T.StructField("filled", T.LongType()),
    ]
)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file, equal to those of the ``tokenizers`` library.

    The merge runs in ``tiktoken`` on the same vocabulary, which takes a quarter of the time;
    texts with a very long unbroken run go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        special = {x["content"]: x["id"] for x in vocabulary["added_tokens"]}
        letters = byte_alphabet()
        ranks = {
            bytes(letters[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items() if token not in special
        }
        self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        self.exact = Tokenizer.from_file(path)
        self.long_space = re.compile(rf"\s{{{LONG_WORD}}}")

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= LONG_WORD and (max(map(len, text.split()), default=0) >= LONG_WORD or self.long_space.search(text)):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Cut the ids of every document, end token included, into full windows and a remainder.

    ``ids`` is little-endian unsigned 32-bit. ``part`` and ``rank`` number the pieces of one
    length within the task that made them: write the result before it is used twice.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, seen, part = Encoder(tokenizer), np.zeros(window + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc, start, len(piece), piece.tobytes(), len(ids), part, seen[len(piece)]))
                    seen[len(piece)] += 1
            made = pd.DataFrame(rows, columns=PIECES.names)
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(cut, PIECES)


class Capacities:
    """Segment tree over remaining capacities: whether any open window has that much room."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [False] * (2 * self.size)

    def set(self, room: int, value: bool) -> None:
        node = self.size + room
        self.any[node] = value
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of an open window that is at least ``least``."""
        node = self.size + least
        if self.any[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_runs(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` pieces of each length.

    Placing the pieces of one length one after the other, each into the window with the least
    sufficient room, fills a window with as many as fit before it turns to the next. So whole
    runs of alike windows can be placed at once, with the result of the piecewise algorithm.
    Rows as in ``RUNS``: the pieces ranked from ``first_rank`` go ``per_window`` at a time to
    the windows numbered from ``first_window``, which are ``filled`` that far.
    """
    tree, open_windows, made, runs = Capacities(window), {}, 0, []

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_windows.setdefault(room, deque()).append((first, n))
            tree.set(room, True)

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = window
                each = room // length
                first, there = made, -(-left // each)
                made += there
            else:
                each = room // length
                first, there = open_windows[room].popleft()
                if not open_windows[room]:
                    tree.set(room, False)
            whole, rest = divmod(min(left, there * each), each)
            if whole:
                runs.append((length, rank, whole * each, each, first, window - room))
                put(room - each * length, first, whole)
            if rest:
                runs.append((length, rank + whole * each, rest, each, first + whole, window - room))
                put(room - rest * length, first + whole, 1)
            put(room, first + whole + bool(rest), there - whole - bool(rest))
            rank += whole * each + rest
            left -= whole * each + rest
    return runs


def best_fit(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``length``, ``part`` and ``rank``.

    ``pieces`` is read twice and must be a written table. The runs are broadcast: their number
    is bounded by the window, whatever the corpus.
    """
    spark = pieces.sparkSession
    per_part = pieces.groupBy(F.col("part").alias("_part"), F.col("length").alias("_length")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = F.broadcast(spark.createDataFrame(best_fit_runs(counts, window), RUNS))
    ranked = (
        pieces.join(bases, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
        .withColumn("_rank", F.col("_base") + F.col("rank"))
        .drop("_part", "_length", "_base", "part", "rank")
    )
    at = F.col("_rank") - F.col("first_rank")
    inside = (at >= 0) & (at < F.col("pieces"))
    return (
        ranked.join(runs, (F.col("length") == F.col("run_length")) & inside)
        .withColumn("sequence_id", F.col("first_window") + F.floor(at / F.col("per_window")).cast("long"))
        .withColumn("offset", F.col("filled") + (at % F.col("per_window")) * F.col("length"))
        .drop("_rank", *RUNS.names)
    )


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """All documents as pieces with their ids and their place in a sequence of ``window`` tokens."""
    return best_fit(written(token_pieces(docs, tokenizer, window, end_id), "pieces"), window)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, its pieces joined in order. A sequence holds at most one window."""
    place = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.aggregate(
            F.sort_array(F.collect_list(place)), F.lit(b"").cast("binary"), lambda whole, piece: F.concat(whole, piece["ids"])
        ).alias("ids"),
        F.sum("length").alias("tokens"),
    )
