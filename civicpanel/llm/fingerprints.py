"""I-Match fingerprints over randomised lexicon subsets.

Terms are lower-cased runs of ASCII letters, digits, underscores and other than ASCII
characters, hashed to a fixed number of buckets; document frequencies of the buckets are counted over all documents. The lexicon is
the band of buckets whose inverse document frequency ln(N / df) lies in ``idf_band``. It
reaches the tasks as one bit per bucket, so its size does not depend on the corpus.

A fingerprint joins one hash per lexicon subset: of the sorted distinct buckets of the text
that are in the subset. Subsets are drawn at random in several sizes (a half, a quarter, and
so on of the lexicon), so that both short and long texts have subsets in which an edit
changes nothing. Two fingerprints are as alike as the share of equal hashes among the
subsets in which at least one of the texts has a term; equal ones are alike to 1.

A text without a term of the band is fingerprinted by all its terms, and one without terms
(NULL counts as empty) gets zeros. Equal texts have equal fingerprints, whatever their rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm.common import RunHashes, bytes_of, mix64, small_batches, text_or_empty

BUCKETS = 1 << 22
IDF_BAND = (2.0, 9.0)
#: Lexicon subsets: so many draws, each in sizes of 1/2 to 1/2**SIZES of the lexicon.
DRAWS, SIZES = 4, 8
EMPTY = "0" * 8
#: Text in one range of documents, about.
RANGE_BYTES = 128 << 20
#: Level of a draw: trailing zero bits, of as many as there are sizes. Where each level ends in a sorted draw.
LEVELS = np.array([SIZES if not x else (x & -x).bit_length() - 1 for x in range(2**SIZES)], np.uint64)
ENDS = np.arange(1, SIZES + 1, dtype=np.uint64) << np.uint64(32)
#: ASCII letters, digits, the underscore and the bytes of all other characters.
TERM_BYTES = np.array([b >= 128 or chr(b).isalnum() or b == ord("_") for b in range(256)])


class TermBuckets:
    """Sorted distinct term buckets of a text."""

    def __init__(self):
        self.hashes = RunHashes(TERM_BYTES)

    def __call__(self, text: str) -> np.ndarray:
        return np.unique(self.hashes(bytes_of(text.lower())) % np.uint64(BUCKETS)).astype(np.uint32)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(bucket, df) over all documents; each task sums its own before they are shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets, seen = TermBuckets(), np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for text in batch["text"]:
                seen[buckets(text)] += 1
        found = np.flatnonzero(seen)
        for at in range(0, len(found), 100_000):
            some = found[at : at + 100_000]
            yield pd.DataFrame({"bucket": some.astype(np.int32), "n": seen[some]})

    small_batches(docs.sparkSession)
    counted = docs.select(text_or_empty().alias("text")).mapInPandas(count, "bucket int, n int")
    return counted.groupBy("bucket").agg(F.sum("n").alias("df"))


def lexicon(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> bytes:
    """One bit per bucket: whether its inverse document frequency is in the band."""
    n = docs.count()
    low, high = (n / math.exp(x) for x in reversed(idf_band))
    chosen = document_frequencies(docs).where(F.col("df").between(low, high)).select("bucket").toPandas()
    bits = np.zeros(BUCKETS, bool)
    bits[chosen["bucket"].to_numpy(np.int64)] = True
    return zlib.compress(np.packbits(bits).tobytes())


class Fingerprinter:
    def __init__(self, packed: bytes):
        self.band = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).astype(bool)
        self.buckets = TermBuckets()

    def __call__(self, text: str) -> str:
        terms = self.buckets(text)
        kept = terms[self.band[terms]]
        return self.of_terms(kept if len(kept) else terms)

    @staticmethod
    def of_terms(terms: np.ndarray) -> str:
        """``terms``: distinct buckets. Each draw gives a term a level, and subset n has the levels above n.

        Sorted by falling level, then by term, the subsets of a draw are beginnings of one list.
        """
        hashes = []
        for draw in range(DRAWS):
            level = LEVELS[(mix64(terms, draw + 1) & np.uint64(2**SIZES - 1)).astype(np.intp)]
            key = ((SIZES - level) << np.uint64(32)) | terms
            key.sort()
            ends, data = np.searchsorted(key, ENDS).tolist(), key.tobytes()
            found, start = 1, 0
            for end in ends:
                found = zlib.crc32(data[8 * start : 8 * end], found)
                hashes.append(b"%08x" % found if end else b"00000000")
                start = end
        return b"".join(hashes).decode()


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    pairs = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
    compared = [x == y for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(compared) / len(compared) if compared else 0.0


def fingerprints(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    packed = lexicon(docs, idf_band)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fingerprint = Fingerprinter(packed)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fingerprint": [fingerprint(t) for t in batch["text"]]})

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return narrow.mapInPandas(compute, "doc_id long, fingerprint string")


def cuts_of(keyed: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of about ``n`` ranges of (key, hash): quantiles of the keys, a key of several of them cut by hash."""
    found = keyed.approxQuantile("key", [i / n for i in range(1, n)], 0.2 / n)
    keys, times = np.unique(np.array(found, np.float64).clip(-(2.0**63), 2.0**63 - 1025).astype(np.int64), return_counts=True)
    # Hashes are spread evenly over 64 bits. A key of one quantile is cut before its first hash.
    hashes = [-(2**63) + (2**64 * j) // (t + 1) if t > 1 else -(2**63) for t in times.tolist() for j in range(1, t + 1)]
    return np.repeat(keys, times), np.array(hashes, np.int64)


def range_numbers(cuts: tuple[np.ndarray, np.ndarray], keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How many cuts are not above each (key, hash)."""
    low, high = np.searchsorted(cuts[0], keys, side="left"), np.searchsorted(cuts[0], keys, side="right")
    found = low.copy()
    for at in np.unique(low[high > low]):
        rows = np.flatnonzero((low == at) & (high > low))
        found[rows] += np.searchsorted(cuts[1][at : high[rows[0]]], hashes[rows], side="right")
    return found


def own_partitions(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` numbers an integer whose hash sends it to the partition of that number."""
    want, found, at = set(range(n)), {}, 0
    while want:
        rows = spark.range(at, at + 16 * n).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"))
        for r in rows.groupBy("p").agg(F.min("id").alias("id")).collect():
            if r["p"] in want:
                found[r["p"]] = r["id"]
                want.discard(r["p"])
        at += 16 * n
    return [found[p] for p in range(n)]


def with_next(docs: DataFrame) -> DataFrame:
    """Texts in ranges of descending (document id, hash of the text), each followed by the first row of the next.

    Ranges hold about ``RANGE_BYTES`` of text and have a partition each; an id of many rows,
    such as none, is cut by the hash. Rows are sorted within their partition by (range, tail,
    id, hash), descending. Only the bounds of the ranges, two pairs of numbers each, pass
    through the driver. NULL ids come last. Rows alike in id and text stay together.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        text_or_empty().alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    cuts, partitions = cuts_of(keyed, n), own_partitions(spark, n)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, hashed: pd.Series) -> pd.Series:
        return pd.Series(range_numbers(cuts, key.to_numpy(np.int64), hashed.to_numpy(np.int64)))

    ranged = keyed.withColumn("range", range_of("key", "hash"))
    heads = ranged.groupBy("range").agg(F.max(F.struct("key", "hash")).alias("head")).collect()
    heads = sorted((r["range"], *r["head"]) for r in heads)
    # The first row of a range is also the tail of the range above it; that of the highest one, of the lowest.
    above = {r: heads[(i + 1) % len(heads)][0] for i, (r, _, _) in enumerate(heads)}
    each = {r: (key, hashed) for r, key, hashed in heads}

    @F.pandas_udf("array<struct<range:int,tail:int>>")
    def places(found: pd.Series, key: pd.Series, hashed: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"range": r, "tail": 0}, {"range": above[r], "tail": 1}] if each[r] == (k, h) else [{"range": r, "tail": 0}]
                for r, k, h in zip(found, key, hashed)
            ]
        )

    return (
        ranged.withColumn("place", F.explode(places("range", "key", "hash")))
        .select("doc_id", "key", "hash", "text", "place.range", "place.tail")
        .repartition(n, F.element_at(F.lit(partitions), F.col("range") + 1).cast("int"))
        .sortWithinPartitions("range", "tail", F.desc("key"), F.desc("hash"))
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, idf_band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprints of every text and of the text whose second half comes from the next document."""
    packed = lexicon(docs, idf_band)

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fingerprint, waiting = Fingerprinter(packed), None
        for batch in batches:
            rows = []
            for doc, text, tail in zip(batch["doc_id"].astype("Int64"), batch["text"], batch["tail"]):
                own = fingerprint(text)
                if waiting is not None:
                    before, first, mine = waiting
                    half = len(first) // 2
                    edited = first[: len(first) - half] + text[:half]
                    changed = fingerprint(edited)
                    digest = hashlib.sha256(edited.encode()).hexdigest()
                    rows.append((before, len(first), digest, mine, changed, likeness(mine, changed), likeness(mine, own)))
                # A range ends with its first tail row; other tail rows are the same text again.
                waiting = None if tail else (doc, text, own)
            made = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    small_batches(docs.sparkSession)
    return with_next(docs).mapInPandas(compute, RESULT)
