"""Near duplicates by MinHash signatures in an LSH forest, confirmed on full shingle sets.

1.  Every text becomes its set of word shingles (64-bit hashes) and a signature of minima.
    Rows with the same set are one class, named by a 64-bit hash of it, so exact copies,
    however many, go on as one.
2.  The forest holds the classes in several orders, each by its own sequence of signature
    columns. Classes that agree in the first ``DEPTH`` columns of an order are neighbours in
    it and meet in a region.
3.  Inside a region, classes whose whole signatures agree in ``LIKELY`` of the columns become
    candidates of each other, a spanning forest of which is kept. True pairs agree in 80 % and
    more, so candidate components hold together what belongs together. Of a region with more
    than ``REGION`` classes all are candidates, without a look at their signatures: no pair
    is lost there, and none of its rows are collected.
4.  The full sets of a candidate component are compared: breadth first, each class with those
    not yet reached, so a group of copies of one text needs about two comparisons each and
    no pair of the group is ever listed. Components beyond ``BLOCK`` shingles are cut into
    blocks, and every two blocks compared in a task of their own; no partner is left out.
5.  Confirmed links give the components.

Words are what stands between white space after lower-casing A-Z; a text with fewer words
than a shingle has its whole sequence as its only shingle. NULL texts and texts without
words have empty sets and are linked with nothing. Rows are linked by their texts, never by
their ids: different texts with one id, or without one, are judged apart. NULL ids count as
larger than all others, a component of such rows only has a NULL id. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.common import LOWER, STEP, RunHashes, bytes_of, mix64, small_batches, text_or_empty, written
from civicpanel.llm.components import connected

COLUMNS = 128
#: Orders of the forest; columns that neighbours share. All orders miss a pair of similarity 0.8 three times in 10**5.
ORDERS, DEPTH = 40, 5
#: Classes of a region whose signatures are compared; of more than this all are candidates.
REGION = 256
#: Share of equal signature columns of a candidate; a similarity of 0.8 misses it once in 10**7.
LIKELY = 0.6
#: Shingles that one task compares.
BLOCK = 2_000_000
NO_ID = 2**63 - 1

WORD_BYTES = np.array([b not in (0x20, *range(0x09, 0x0E)) for b in range(256)])
FACTORS = mix64(np.arange(COLUMNS), 11) | np.uint64(1)
FACTOR = np.uint64(STEP)


def shingle_set(text: str, words: int, hashes: RunHashes) -> np.ndarray:
    """Sorted distinct shingles of a text."""
    each = hashes(LOWER[bytes_of(text)])
    if not len(each):
        return each
    size = min(words, len(each))
    whole = np.full(len(each) - size + 1, size, np.uint64)
    for i in range(size):
        whole = mix64(whole * FACTOR + each[i : i + len(whole)])
    return np.unique(whole)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of ``COLUMNS`` hash functions, cut to 16 bits."""
    least = np.full(COLUMNS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[at : at + 2048, None] * FACTORS).min(axis=0), out=least)
    return (mix64(least) & np.uint64(0xFFFF)).astype(np.uint16)


def order_columns(order: int) -> np.ndarray:
    return np.random.default_rng(order).permutation(COLUMNS)


def region_keys(signatures: np.ndarray, order: int, depth: int) -> np.ndarray:
    """A hash of the first ``depth`` columns of an order, per line of ``signatures``."""
    key = np.full(len(signatures), order * 1000 + depth, np.uint64)
    for column in order_columns(order)[:depth]:
        key = mix64(key * FACTOR + signatures[:, column])
    return key.view(np.int64)


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(id, key, n_shingles, node, signature) of every row; ``node`` is the class."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = RunHashes(WORD_BYTES)
        for batch in batches:
            sets = [shingle_set(t, words, hashes) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "key": batch["key"],
                    "n_shingles": [len(s) for s in sets],
                    "node": [class_of(s) for s in sets],
                    "signature": [signature(s).tobytes() for s in sets],
                }
            )

    return texts_of(docs).mapInPandas(sign, "id long, key long, n_shingles long, node long, signature binary")


def texts_of(docs: DataFrame) -> DataFrame:
    """(id, key, text) of every row; ``key`` tells texts of one id apart."""
    small_batches(docs.sparkSession)
    found = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_or_empty().alias("text"))
    return found.select("id", F.xxhash64("text").alias("key"), "text")


def class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, COLUMNS)


def runs(batches: Iterator[pd.DataFrame], *keys: str) -> Iterator[pd.DataFrame]:
    """Rows with equal keys from batches sorted by them."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        for key, part in batch.groupby(list(keys), sort=False):
            if key != last and held:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def candidate_edges(classes: DataFrame) -> DataFrame:
    """(a, b) between classes with alike signatures: neighbours in some order of the forest."""

    def base(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = matrix(batch["signature"])
            for order in range(ORDERS):
                yield pd.DataFrame({"region": region_keys(lines, order, DEPTH), "node": batch["node"]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in runs(batches, "region"):
            nodes, lines = batch["node"].to_numpy(), matrix(batch["signature"]).astype(np.uint8)
            alike = lambda v, rest: (lines[rest] == lines[v]).mean(axis=1) >= LIKELY  # noqa: E731, B023
            a, b = spanning(len(nodes), alike)
            yield pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    regions = classes.select("node", "signature").mapInPandas(base, "region long, node long")
    shared = regions.groupBy("region").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1")
    members = written(regions.join(shared, "region"), "members")
    crowded = members.where(F.col("size") > REGION).select(F.col("node").alias("a"), F.col("least").alias("b"))
    few = members.where(F.col("size") <= REGION).select("region", "node").join(classes.select("node", "signature"), "node")
    together = few.repartition("region").sortWithinPartitions("region", "signature", "node")
    return together.mapInPandas(compare, "a long, b long").union(crowded)


def spanning(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest: each node is compared with those not reached yet."""
    left, a, b = np.arange(n), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            v = queue.pop()
            hit = linked(v, left)
            found, left = left[hit], left[~hit]
            a += [v] * len(found)
            b += list(found)
            queue += list(found)
    return np.array(a, int), np.array(b, int)


def confirmed_edges(docs: DataFrame, classes: DataFrame, candidates: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of a spanning forest of the links between classes of one candidate component."""
    members = classes.select("node", "n_shingles", "row.id", "row.key").join(candidates, "node")
    totals = members.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("total") / (BLOCK / 2))).cast("int")
    placed = (
        members.join(totals.withColumn("blocks", F.when(F.col("total") <= BLOCK, 1).otherwise(blocks)), "component")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks").cast("long")).cast("int"))
        .select("id", "key", "node", "component", "block", "blocks")
    )

    def reread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, read = RunHashes(WORD_BYTES), set()
        for batch in batches:
            # Rows with the same id and text stand for one class: one of them is enough.
            batch = batch[~(batch["node"].duplicated() | batch["node"].isin(read))]
            sets = [shingle_set(t, words, hashes) for t in batch["text"]]
            same = [class_of(s) == n for s, n in zip(sets, batch["node"])]
            read.update(batch["node"][same])
            yield batch.drop(columns=["id", "key", "text"]).assign(shingles=[s.tobytes() for s in sets])[same]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, "component", "pair"):
            nodes, first = np.unique(group["node"].to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].iloc[first]]
            a, b = spanning(len(nodes), overlaps(sets, percent))
            yield pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    texts = texts_of(docs).join(placed, ["id", "key"])
    sets = texts.mapInPandas(reread, "node long, component long, block int, blocks int, shingles binary")
    # One block is compared with itself; of several, every two (both orders have one name).
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = F.when(F.col("blocks") == 1, F.array(F.lit("0"))).otherwise(
        F.transform(
            F.filter(others, lambda j: j != F.col("block")),
            lambda j: F.concat_ws("-", F.least(j, F.col("block")), F.greatest(j, F.col("block"))),
        )
    )
    dealt = sets.withColumn("pair", F.explode(pairs)).select("component", "pair", "node", "shingles")
    together = dealt.repartition("component", "pair").sortWithinPartitions("component", "pair", "node")
    return together.mapInPandas(compare, "a long, b long")


def overlaps(sets: list[np.ndarray], percent: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether 100 * intersection >= percent * union, of one set with some others."""
    sizes = np.array([len(s) for s in sets])
    names, index = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marked = np.zeros(len(names), bool)

    def linked(v: int, rest: np.ndarray) -> np.ndarray:
        marked[index[starts[v] : ends[v]]] = True
        hits = np.concatenate([[0], np.cumsum(marked[np.concatenate([index[starts[w] : ends[w]] for w in rest])])])
        at = np.concatenate([[0], np.cumsum(sizes[rest])])
        both = hits[at[1:]] - hits[at[:-1]]
        marked[index[starts[v] : ends[v]]] = False
        return 100 * both >= percent * (sizes[v] + sizes[rest] - both)

    return linked


def judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, key, n_shingles, node, component, first) of every row of ``docs``.

    ``component`` is the smallest id that links lead to, ``first`` the (id, node) of the class
    that stays; both are the row's own where it has no shingles.
    """
    rows = written(signed(docs, words), "signed")
    classes = written(
        rows.where("n_shingles > 0").groupBy("node").agg(
            F.min(F.struct("id", "key")).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    candidates = connected(candidate_edges(classes))
    found = connected(written(confirmed_edges(docs, classes, candidates, words, percent), "links"))
    firsts = found.join(classes.select("node", "row.id"), "node").groupBy("component").agg(F.min(F.struct("id", "node")).alias("first"))
    of_class = classes.select("node", "row.id").join(found.join(firsts, "component").select("node", "first"), "node", "left")
    of_class = of_class.select("node", F.coalesce("first", F.struct("id", "node")).alias("first"))
    return (
        rows.drop("signature").join(of_class, "node", "left")
        .withColumn("first", F.coalesce("first", F.struct("id", "node")))
        .select("id", "key", "n_shingles", "node", F.col("first.id").alias("component"), "first")
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Documents with 100 * intersection >= ``percent`` * union of their sets of ``words``-word
    shingles are linked; ``component_id`` is the smallest id that links lead to. Of several
    texts with that id in a component, the rows of one are ``kept``.
    """
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return judged(docs, words, percent).select(
        known("id").alias("doc_id"), "n_shingles", known("component").alias("component_id"),
        (F.struct("id", "node") == F.col("first")).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, columns as they are.

    Of several rows with that id, or without one, a component keeps one; of rows without
    shingles, those with equal ids and texts count once.
    """
    kept = judged(docs, words, percent).where(F.struct("id", "node") == F.col("first"))
    one = F.when(F.col("n_shingles") > 0, F.lit(0)).otherwise(F.col("key"))
    kept = kept.groupBy("id", "node", one).agg(F.min("key").alias("_text")).select(F.col("id").alias("_id"), "_text")
    whole = docs.select(
        F.struct("*").alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text_or_empty()).alias("_text"),
    )
    return whole.join(kept, ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"]).select("_row.*")
