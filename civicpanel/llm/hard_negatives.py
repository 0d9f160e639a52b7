"""Hard negatives by rotated one-bit codes, exact.

1.  Vectors become whole numbers, ``floor(scale * x)``, and are stored in chunks of rows. Each
    row keeps the signs of its rotated vector (one bit per dimension), its squared length and
    the alignment of the rotated vector with its code. The rotation is three rounds of random
    signs and a Hadamard transform, so it is orthonormal and needs no matrix.
2.  An anchor's rotated vector is written in ``BITS`` bit planes. Popcounts of planes and code
    give its product with the code, and times the alignment an estimate of the score. What the
    code does not see is perpendicular to it, in row and anchor, so by Cauchy-Schwarz the
    score differs by at most the product of both residuals. Only rows whose interval can still
    reach a result are scored, with whole numbers. Nothing is lost, whatever the data.
3.  Positives are the best ``positives`` other rows with the anchor's label. For each of them the
    best ``negatives`` rows of other labels with a score of ``low`` to ``high`` percent of the
    positive's follow in a second search.

The anchors are the query set. They are packed into blocks, each row chunk meets each block
once per search, and what a task holds are the best rows so far of ``PASS_BLOCKS`` blocks;
more anchors take more passes. Blocks and chunks meet by row groups: as many as there are
shuffle partitions, divided among the passes, but one for each core at least. Every pass writes
the best of its lists only, so what tasks report grows with the anchors and not with their
product with the rows. No label, id or vector is a key of a shuffle of rows, and no table is
broadcast: the driver holds counts and the rotation's signs.

Rows with a NULL label, a NULL vector, or a component that is NULL or not finite take no part.
Shorter vectors count as filled with zeros, empty ones score 0. Rows with a NULL id are no
anchors and come last among ties. Each row counts by itself, repeated ids and rows too: a
second row with an anchor's id is another row. Scores beyond 2**62 count as that. An empty
table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicpanel.llm.common import written

SCALE = 256
BITS = 4
ROUNDS = 3
#: Components in one chunk of rows, and anchors in a block.
CHUNK_CELLS = 1 << 17
BLOCK = 1024
#: Blocks whose best rows a task holds at once.
PASS_BLOCKS = 64
#: Anchors compared with a chunk at once.
TILE = 64
#: How tables of blocks or lists are joined. Spark would broadcast some of them, judging by their
#: compressed files, which may be a hundredth of the rows, and by no factor for exploded ones.
SHUFFLED = "merge"
#: Chunks and blocks are wide rows: of few a scan makes a batch, and pages end by their size. By
#: default a batch has 4,096 and a page 100 at least, which is gigabytes where they compress well.
WIDE_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "16", "parquet.page.size.row.check.min": "1"}
NO_ID = np.iinfo(np.int64).max
NONE = -(1 << 62)
#: Scores below this are exact in doubles and leave room for a rank in 64 bits.
SMALL = 2.0**48

CHUNKS = "chunk long, n int, kind string, ids binary, labels binary, anchors binary, vectors binary, codes binary, aligned binary, lengths binary"
BLOCKS = "block int, ids array<long>, chunks array<long>, places array<long>, labels array<long>, vectors binary"
FOUND = "block int, anchor int, target int, id long, score long"


def width(longest: int) -> int:
    """Dimensions of rotated vectors: a power of two, whole words of bits."""
    return max(64, 1 << max(0, longest - 1).bit_length())


def signs(wide: int, seed: int = 0) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (ROUNDS, wide))


def rotated(rows: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """Rows times an orthonormal matrix."""
    count, wide = rows.shape
    for flip in flips:
        rows, half = rows * flip, 1
        while half < wide:
            pairs = rows.reshape(count, -1, 2, half)
            rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, wide)
            half *= 2
        rows = rows / np.sqrt(wide)
    return rows


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def smallest(values: np.ndarray) -> tuple[str, np.ndarray]:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(values).max(initial=0)
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return kind, values.astype(kind)


@dataclass
class Chunk:
    """Rows with their codes, by id."""

    key: int
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    aligned: np.ndarray
    lengths: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Chunk:
        n = row["n"]
        return cls(
            row["chunk"], np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"),
            np.frombuffer(row["vectors"], row["kind"]).reshape(n, -1).astype(float),
            np.frombuffer(row["codes"], "<u8").reshape(n, -1),
            np.frombuffer(row["aligned"], "<f8"), np.frombuffer(row["lengths"], "<f8"),
        )

    def only(self, places: np.ndarray) -> Chunk:
        """The rows at these places."""
        return Chunk(self.key, *[getattr(self, f)[places] for f in ("ids", "labels", "vectors", "codes", "aligned", "lengths")])


def chunk_rows(batch: pa.RecordBatch, flips: np.ndarray, key: int) -> dict:
    """One row of ``CHUNKS`` from a batch of (id, label, anchor, vector)."""
    wide, n = flips.shape[1], len(batch)
    lists = batch["vector"]
    sizes = np.diff(lists.offsets.to_numpy())
    cells = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
    values = np.zeros((n, wide))
    values[np.repeat(np.arange(n), sizes), np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = cells
    ids = batch["id"].fill_null(NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    values = values[order]
    turned = rotated(values, flips)
    bits = turned > 0
    kind, stored = smallest(values)
    arrays = {
        "ids": ids[order].astype("<i8"), "labels": batch["label"].to_numpy()[order].astype("<i8"),
        "anchors": batch["anchor"].to_numpy(zero_copy_only=False)[order].astype(np.uint8), "vectors": stored, "codes": packed(bits),
        "aligned": np.abs(turned).sum(axis=1) / np.sqrt(wide), "lengths": (values * values).sum(axis=1),
    }
    return {"chunk": key, "n": n, "kind": kind} | {name: a.tobytes() for name, a in arrays.items()}


class Block:
    """Anchors with their bit planes."""

    def __init__(self, row: dict, flips: np.ndarray):
        self.block = row["block"]
        self.chunks, self.places, self.ids, self.labels = (np.array(row[c], np.int64) for c in ("chunks", "places", "ids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(len(self.ids), -1)
        turned = rotated(self.vectors, flips)
        self.wide = turned.shape[1]
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << BITS) - 1), 1e-12)
        units = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, (1 << BITS) - 1).astype(np.uint8)
        self.planes = [packed((units >> b) & 1) for b in range(BITS)]
        self.units = units.sum(axis=1, dtype=float)
        self.error = np.linalg.norm(turned - self.low[:, None] - self.step[:, None] * units, axis=1)
        self.length = (self.vectors * self.vectors).sum(axis=1)


def products(planes: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Sums of the anchors' units (rows) where the rows' codes (columns) have ones."""
    counts = np.zeros((len(planes[0]), len(codes)), np.int32)
    for word, code in enumerate(np.ascontiguousarray(codes.T)):
        # A count is 64 at most, so two planes of a word fit into a byte.
        for b in range(0, BITS, 2):
            pair = np.bitwise_count(planes[b][:, word, None] & code)
            if b + 1 < BITS:
                pair += np.bitwise_count(planes[b + 1][:, word, None] & code) << np.uint8(1)
            counts += pair.astype(np.int32) << b
    return counts


def intervals(block: Block, tile: slice | np.ndarray, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of a tile of anchors with all rows of a chunk."""
    ones = np.bitwise_count(chunk.codes).sum(axis=1, dtype=float)
    low, step, error, root = block.low[tile], block.step[tile], block.error[tile], np.sqrt(block.wide)
    # Terms of an anchor times terms of a row, added up in one product.
    outer = lambda anchor, row: np.stack(anchor, axis=1) @ np.stack(row)
    along = products([plane[tile] for plane in block.planes], chunk.codes) * (2 * step / root)[:, None]
    along += outer([2 * low / root, -(step * block.units[tile] + block.wide * low) / root], [ones, np.ones(len(ones))])
    half = np.abs(along)
    half -= error[:, None]
    np.maximum(half, 0, out=half)
    half *= half
    np.subtract(block.length[tile, None], half, out=half)
    np.maximum(half, 0, out=half)
    np.sqrt(half, out=half)
    half *= np.sqrt(np.maximum(chunk.lengths - chunk.aligned**2, 0))
    # Widened for the rounding of the doubles above.
    half += outer([error, 1e-9 * np.sqrt(block.length[tile])], [chunk.aligned, np.sqrt(chunk.lengths)])
    half += 1e-6
    along *= chunk.aligned
    return along - half, along + half


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; Python's integers where doubles would round."""
    if len(rows) == 0 or len(anchors) == 0:
        return np.zeros((len(anchors), len(rows)), np.int64)
    most = np.sqrt((anchors * anchors).sum(axis=1).max() * (rows * rows).sum(axis=1).max())
    if most < SMALL:
        return (anchors @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in line] for line in m], object)
    return np.clip(whole(anchors) @ whole(rows).T, NONE + 1, -NONE)


def best(found: np.ndarray, valid: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the first ``k`` valid columns of each row, by score, then by column."""
    columns = found.shape[1]
    # Score and column in one number; Python's integers if they do not fit into 64 bits.
    kind = np.int64 if not valid.any() or np.abs(found[valid]).max() < SMALL else object
    ranks = found.astype(kind) * columns + np.arange(columns - 1, -1, -1)
    ranks = np.where(valid, ranks, NONE * (1 if kind is np.int64 else columns + 1))
    if kind is np.int64 and columns > k:
        ranks = np.partition(ranks, columns - k, axis=1)
    ranks = np.sort(ranks, axis=1)[:, ::-1][:, :k]
    there = np.arange(ranks.shape[1])[None, :] < valid.sum(axis=1)[:, None]
    score = np.where(there, ranks // columns, NONE).astype(np.int64)
    column = np.where(there, columns - 1 - ranks % columns, 0).astype(np.int64)
    return score, np.where(there, ids[column], NO_ID)


class Best:
    """The best ``k`` (score, id) of many lists so far."""

    def __init__(self, lists: tuple[int, ...], k: int):
        self.k = k
        self.score = np.full((*lists, k), NONE, np.int64)
        self.id = np.full((*lists, k), NO_ID, np.int64)

    def worst(self, at) -> np.ndarray:
        """What a further row must reach."""
        return self.score[at][..., -1]

    def add_from(self, at, found: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> None:
        """Add the valid scores of the rows ``ids``."""
        some = np.flatnonzero(valid.any(axis=0))
        if len(some):
            self.add(at, *best(found[:, some], valid[:, some], ids[some], self.k))

    def add(self, at, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[at], score], axis=-1), np.concatenate([self.id[at], ids], axis=-1)
        order = np.lexsort((ids, -score), axis=-1)[..., : self.k]
        self.score[at], self.id[at] = np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


class Positives:
    """Best other rows with the anchor's label."""

    def __init__(self, row: dict, flips: np.ndarray, k: int):
        self.block = Block(row, flips)
        self.by_label = np.argsort(self.block.labels, kind="stable")
        self.best = Best((len(self.block.ids), 1), k)

    def meet(self, chunk: Chunk) -> int:
        """Compare with a chunk; the number of rows that were scored."""
        block, scored = self.block, 0
        for at in range(0, len(block.ids), TILE):
            tile = self.by_label[at : at + TILE]
            alike = np.flatnonzero(np.isin(chunk.labels, block.labels[tile]))
            if len(alike) == 0:
                continue
            part = chunk.only(alike)
            wanted = block.labels[tile, None] == part.labels
            own = np.flatnonzero(block.chunks[tile] == chunk.key)
            wanted[own, np.searchsorted(alike, block.places[tile][own])] = False
            worst = self.best.worst((tile, 0))[:, None]
            wanted &= intervals(block, tile, part)[1] >= worst
            scored += int(wanted.sum())
            columns = np.flatnonzero(wanted.any(axis=0))
            if len(columns):
                found = scores(block.vectors[tile], part.vectors[columns])
                self.best.add_from((tile, 0), found, wanted[:, columns] & (found >= worst), part.ids[columns])
        return scored


class Negatives:
    """Best rows of other labels within the range of each positive."""

    def __init__(self, row: dict, flips: np.ndarray, k: int, low: int, high: int):
        self.block = Block(row, flips)
        n, targets = len(self.block.ids), 1 + max((t["target"] for t in row["targets"]), default=0)
        self.from_, self.to = np.full((n, targets), -NONE, np.int64), np.full((n, targets), NONE, np.int64)
        for t in row["targets"]:
            least, most = -(-low * t["score"] // 100), high * t["score"] // 100
            if least <= most:
                self.from_[t["anchor"], t["target"]], self.to[t["anchor"], t["target"]] = least, most
        self.best = Best((n, targets), k)

    def meet(self, chunk: Chunk) -> int:
        """Compare with a chunk; the number of rows that were scored."""
        block, scored = self.block, 0
        for at in range(0, len(block.ids), TILE):
            tile = slice(at, at + TILE)
            below, above = intervals(block, tile, chunk)
            least = np.maximum(self.from_[tile], self.best.worst(tile)).min(axis=1)[:, None]
            most = self.to[tile].max(axis=1)[:, None]
            wanted = (block.labels[tile, None] != chunk.labels) & (above >= least) & (below <= most)
            columns = np.flatnonzero(wanted.any(axis=0))
            if len(columns):
                found = scores(block.vectors[tile], chunk.vectors[columns])
                near = wanted[:, columns] & (found >= least) & (found <= most)
                some = np.flatnonzero(near.any(axis=0))
                found, near, ids = found[:, some], near[:, some], chunk.ids[columns[some]]
                for t in range(self.to.shape[1]):
                    from_ = np.maximum(self.from_[tile, t], self.best.worst((tile, t)))
                    valid = near & (found >= from_[:, None]) & (found <= self.to[tile, t, None])
                    self.best.add_from((tile, t), found, valid.astype(bool), ids)
            scored += int(wanted.sum())
        return scored


def usable(vector: Column, label: Column) -> Column:
    endless = F.lit(float("inf"))
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * SCALE) == endless))
    return label.isNotNull() & vector.isNotNull() & ~broken


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """What is run within writes short pages and reads few rows at once."""
    before = {key: spark.conf.get(key, None) for key in WIDE_ROWS}
    for key, value in WIDE_ROWS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def chunked(rows: DataFrame, flips: np.ndarray) -> DataFrame:
    """(id, label, anchor, vector) as written chunks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(b for b in batches if len(b)):
            yield pa.RecordBatch.from_pylist([chunk_rows(batch, flips, (part << 33) + i)], schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in CHUNKS.split(", ")])
    with wide_rows(rows.sparkSession):
        return written(rows.mapInArrow(encode, CHUNKS), "vector_chunks", max(64, CHUNK_CELLS // flips.shape[1]))


def blocks_of(chunks: DataFrame, total: int, per_block: int) -> DataFrame:
    """The anchors of the chunks as written blocks."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk, flags = Chunk.read(row), np.frombuffer(row["anchors"], np.uint8)
                places = np.flatnonzero(flags)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([row["chunk"]] * len(places), pa.int64()), "place": pa.array(places, pa.int32()),
                        "id": pa.array(chunk.ids[places], pa.int64()), "label": pa.array(chunk.labels[places], pa.int64()),
                        "vector": pa.array([v.astype("<f8").tobytes() for v in chunk.vectors[places]], pa.binary()),
                    }
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in batch.to_pylist()]
        if found:
            lists = {"ids": "id", "chunks": "chunk", "places": "place", "labels": "label"}
            block = {"block": TaskContext.get().partitionId()} | {c: [r[f] for r in found] for c, f in lists.items()}
            kinds = [("block", pa.int32()), *[(c, pa.list_(pa.int64())) for c in lists], ("vectors", pa.binary())]
            yield pa.RecordBatch.from_pylist([block | {"vectors": b"".join(r["vector"] for r in found)}], pa.schema(kinds))

    each = chunks.mapInArrow(anchors, "chunk long, place int, id long, label long, vector binary")
    with wide_rows(chunks.sparkSession):
        return written(each.repartition(-(-total // per_block)).mapInArrow(pack, BLOCKS), "anchor_blocks")


def search(chunks: DataFrame, blocks: DataFrame, make: Callable[[dict], Positives | Negatives], lists: list[str], k: int, name: str) -> DataFrame:
    """The first ``k`` of each list: ``FOUND`` with a rank from 1, written pass by pass."""
    spark = chunks.sparkSession
    of_block = [c for c in blocks.columns if c != "block"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, Positives | Negatives] = {}
        for batch in batches:
            for row in batch.to_pylist():
                state = states.get(row["block"])
                if state is None:
                    state = states[row["block"]] = make({"block": row["block"]} | {c: row[f"of_{c}"] for c in of_block})
                state.meet(Chunk.read(row))
        for number, state in states.items():
            anchor, target, place = np.nonzero(state.best.score > NONE)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(anchor), number), pa.int32()), "anchor": pa.array(anchor, pa.int32()),
                    "target": pa.array(target, pa.int32()), "id": pa.array(state.best.id[anchor, target, place], pa.int64()),
                    "score": pa.array(state.best.score[anchor, target, place], pa.int64()),
                }
            )

    count = blocks.agg(F.max("block")).first()[0]
    passes = range(0, (-1 if count is None else count) + 1, PASS_BLOCKS)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = min(most, max(-(-most // max(1, len(passes))), spark.sparkContext.defaultParallelism))
    found = spark.createDataFrame([], FOUND + ", rank int")
    for at in passes:
        some = blocks.where(F.col("block").between(at, at + PASS_BLOCKS - 1))
        some = some.select("block", *[F.col(c).alias(f"of_{c}") for c in of_block], F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("row_group"))
        dealt = chunks.drop("anchors").withColumn("row_group", F.pmod(F.hash("chunk"), F.lit(groups)))
        best_of = ranked(dealt.join(some.hint(SHUFFLED), "row_group").mapInArrow(compare, FOUND), lists, k)
        with wide_rows(spark):
            found = found.union(written(best_of, name, 16))
    return found


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each list, from 1; a list holds at most ``k`` rows of each task."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    seed: int = 0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all rows where ``anchor`` holds."""
    rows = vectors.where(usable(F.col(vector), F.col(label))).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        (F.coalesce(anchor, F.lit(False)) & F.col(key).isNotNull()).alias("anchor"), F.col(vector).alias("vector"),
    )
    longest, total = rows.agg(F.max(F.size("vector")), F.count_if("anchor")).first()
    if not total:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    flips = signs(width(longest), seed)
    per_block = max(16, min(BLOCK, CHUNK_CELLS // flips.shape[1]))
    chunks = chunked(rows, flips)
    blocks = blocks_of(chunks, total, per_block)
    first = search(chunks, blocks, lambda row: Positives(row, flips, positives), ["block", "anchor"], positives, "positives")
    chosen = first.withColumn("target", F.col("rank") - 1).drop("rank")
    targets = chosen.groupBy("block").agg(F.collect_list(F.struct("anchor", "target", "score")).alias("targets"))
    aimed = blocks.join(targets.hint(SHUFFLED), "block")
    found = search(chunks, aimed, lambda row: Negatives(row, flips, negatives, low, high), ["block", "anchor", "target"], negatives, "negatives")
    known = F.when(F.col("id") != NO_ID, F.col("id"))
    ids = blocks.select("block", F.posexplode("ids").alias("anchor", "anchor_id"))
    pairs = chosen.select("block", "anchor", "target", known.alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.select("block", "anchor", "target", "rank", known.alias("negative_id"), F.col("score").alias("negative_score"))
        .join(pairs.join(ids.hint(SHUFFLED), ["block", "anchor"]).hint(SHUFFLED), ["block", "anchor", "target"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
