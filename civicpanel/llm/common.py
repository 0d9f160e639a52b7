"""What the corpus operators share: shared scratch tables, batch sizes and hashing of 64-bit integers."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Texts are long: the default of 10,000 could hold gigabytes.
BATCH_ROWS = 512


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch of texts holds in a Python worker of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm_scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it back.

    ``batch_rows`` and ``batch_bytes`` bound its Arrow batches: many narrow rows, but few long texts.

    Lineage ends here, so a lost executor costs one read, and what a Python stage has
    computed is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before, bytes_before = spark.conf.get(CLEANUP, None), spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(CLEANUP, "true")  # the shuffles behind a written table are not needed again
    small_batches(spark, batch_rows)
    if batch_bytes:
        spark.conf.set(BATCH_BYTES, str(batch_bytes))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        small_batches(spark)
        if batch_bytes:
            spark.conf.set(BATCH_BYTES, bytes_before) if bytes_before else spark.conf.unset(BATCH_BYTES)
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def release(*written_tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for table in written_tables:
        files = table.inputFiles()
        if files:
            session = table.sparkSession
            folder = session._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)


def tables(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix64(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit value for each one (the finaliser of SplitMix64)."""
    offset = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = values.astype(np.uint64) + offset
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes with A-Z lower-cased.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes hashed at once; a longer run without an end is hashed whole.
SEGMENT = 1 << 20
STEP = 0x9E3779B97F4A7C15


class RunHashes:
    """64-bit hashes of the runs of marked bytes in a text, such as its words, in their order.

    A run is the polynomial of its bytes in an odd factor modulo 2**64, as the difference of
    two sums over the text times the inverse power of where it starts.
    """

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        self._powers(1 << 14)

    def _powers(self, n: int) -> None:
        for name, factor in (("power", STEP), ("inverse", pow(STEP, -1, 2**64))):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray) -> np.ndarray:
        inside = self.marked[data]
        found, at = [], 0
        while at < len(data):
            end = min(at + SEGMENT, len(data))
            if end < len(data):
                gaps = np.flatnonzero(~inside[at:end])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:
                    later = np.flatnonzero(~inside[end:])
                    end = end + int(later[0]) + 1 if len(later) else len(data)
            found.append(self._segment(data[at:end], inside[at:end]))
            at = end
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _segment(self, data: np.ndarray, inside: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.power):
            self._powers(max(n, 2 * len(self.power)))
        edges = np.zeros(n + 2, np.int8)
        edges[1:-1] = inside
        edges = np.flatnonzero(edges[1:] != edges[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def text_or_empty(column: str = "text"):
    """NULL texts count as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
