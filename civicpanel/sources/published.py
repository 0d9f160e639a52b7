"""A star schema whose tables are replaced in part, and that readers always see whole.

Tables are written to a folder of their own per publication. A publication becomes visible
by one small file that lists the folder of every table and of every indicator of the fact;
readers follow the newest list, so they never meet new dimensions with an old fact, nor a
half-written table. Indicators that are not replaced stay where they are.

Lists are appended, so earlier publications can still be read until ``forget_old`` deletes
what they alone refer to. One writer at a time: a publication whose predecessor is no longer
the newest one is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel import schemas
from civicpanel.sources.tables import with_columns_of

LIST = "publicacao BIGINT, tabela STRING, indicador STRING, pasta STRING"
FACT, KEY = "fato_indicador", "id_indicador"
DIMENSIONS = {"dim_estado": schemas.STATE_DIM, "dim_indicador": schemas.INDICATOR_DIM, "dim_governador": schemas.TERM_DIM}


def listed(spark: SparkSession, root: str, publication: int | None = None) -> list[tuple[int, str, str | None, str]]:
    """The rows of one list, of the newest one if not said otherwise; none if nothing is published."""
    try:
        lists = spark.read.schema(LIST).json(f"{root}/lists")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    if publication is None:
        publication = lists.agg(F.max("publicacao")).first()[0]
    return [tuple(r) for r in lists.where(F.col("publicacao") == publication).collect()]


def newest(spark: SparkSession, root: str) -> int:
    """Number of the newest publication, 0 before the first."""
    return max((r[0] for r in listed(spark, root)), default=0)


def stage(
    root: str, fact: DataFrame | None = None, dimensions: Mapping[str, DataFrame] | None = None, folder: str | None = None
) -> tuple[str, dict[str | None, str]]:
    """Write tables to a new folder that no list refers to yet. Rows without an indicator are an error.

    Returned: the folder, and the folders of the indicators of ``fact``. Writing to the same
    ``folder`` again, after a failure, replaces the partitions it has.
    """
    folder = folder or f"{root}/tables/{uuid.uuid4().hex}"
    for name, table in (dimensions or {}).items():
        with_columns_of(table, DIMENSIONS[name]).write.mode("overwrite").parquet(f"{folder}/{name}")
    found = {}
    if fact is not None:
        known = F.when(F.col(KEY).isNotNull(), F.col(KEY)).otherwise(F.raise_error(F.lit("a fact row has no indicator")))
        rows = with_columns_of(fact, schemas.FACT).withColumn(KEY, known)
        (
            rows.hint("rebalance", KEY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(KEY)
            .parquet(f"{folder}/{FACT}")
        )
        written = rows.sparkSession.read.schema(schemas.FACT).parquet(f"{folder}/{FACT}")
        # A catalogue of indicators has a few rows, whatever the fact has.
        found = {r[0]: f"{folder}/{FACT}" for r in written.select(KEY).distinct().collect()}
    return folder, found


def announce(spark: SparkSession, root: str, after: int, rows: Iterable[tuple[str, str | None, str]]) -> int:
    """Make a list the newest one. It is one file, which appears by one rename."""
    if (now := newest(spark, root)) != after:
        raise RuntimeError(f"publication {now} came in between, this one follows {after}")
    table = spark.createDataFrame([(after + 1, *r) for r in rows], LIST)
    table.coalesce(1).write.mode("append").json(f"{root}/lists")
    return after + 1


def publish(
    spark: SparkSession, root: str, fact: DataFrame, states: DataFrame, indicators: DataFrame, terms: DataFrame | None = None
) -> int:
    """Publish all tables anew; the term table is optional. The number of the publication."""
    after = newest(spark, root)
    dimensions = {"dim_estado": states, "dim_indicador": indicators} | ({} if terms is None else {"dim_governador": terms})
    folder, found = stage(root, fact, dimensions)
    rows = [(name, None, f"{folder}/{name}") for name in dimensions] + [(FACT, i, path) for i, path in found.items()]
    return announce(spark, root, after, rows)


def replace(
    spark: SparkSession, root: str, indicators: Iterable[str], fact: DataFrame, dimensions: Mapping[str, DataFrame] | None = None
) -> int:
    """Replace some indicators, and the dimensions given, in one step; the rest is neither read nor written.

    ``fact`` has rows of these indicators only; one without rows is gone afterwards.
    """
    chosen, after = set(indicators), newest(spark, root)
    current = listed(spark, root, after)
    if not current:
        raise FileNotFoundError(f"nothing is published under {root}")
    others = fact.where(~F.coalesce(F.col(KEY).isin(list(chosen)), F.lit(False)))
    if strangers := others.limit(1).collect():
        raise ValueError(f"rows of {strangers[0][KEY]!r}, which is not replaced")
    folder, found = stage(root, fact, dimensions)
    changed = dimensions or {}
    rows = [(t, i, path) for _, t, i, path in current if not (t in changed or (t == FACT and i in chosen))]
    rows += [(name, None, f"{folder}/{name}") for name in changed] + [(FACT, i, path) for i, path in found.items()]
    return announce(spark, root, after, rows)


def read_published(spark: SparkSession, root: str, publication: int | None = None) -> dict[str, DataFrame | None]:
    """The tables of a publication by name, the newest if not said otherwise; the term table may be None.

    Each folder is read with a filter on its indicators, which prunes the partitions of others.
    """
    rows = listed(spark, root, publication)
    if not rows:
        raise FileNotFoundError(f"nothing is published under {root}")
    tables: dict[str, DataFrame | None] = dict.fromkeys((*DIMENSIONS, FACT))
    of_folder: dict[str, list[str]] = {}
    for _, name, indicator, path in rows:
        if name == FACT:
            of_folder.setdefault(path, []).append(indicator)
        else:
            tables[name] = spark.read.schema(DIMENSIONS[name]).parquet(path)
    parts = [spark.read.schema(schemas.FACT).parquet(path).where(F.col(KEY).isin(ids)) for path, ids in sorted(of_folder.items())]
    tables[FACT] = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.FACT)
    return tables


def forget_old(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the folders that none of the ``keep`` newest publications refers to, staged leftovers among them.

    No writer may be at work, and no reader of an older publication.
    """
    last = newest(spark, root)
    used = {path.rsplit("/", 1)[0] for n in range(max(1, last - keep + 1), last + 1) for _, _, _, path in listed(spark, root, n)}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tables")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
    names = {u.rsplit("/", 1)[1] for u in used}
    gone = [p for p in there if p.getName() not in names]
    for p in gone:
        files.delete(p, True)
    return [p.getName() for p in gone]
