"""Roll-ups that are kept up to date: sums, counts, extremes and bitmaps of distinct values.

All of these merge: the state of two sets of rows together follows from their states. So late
rows are added without reading the rows before them, and periods in which rows changed or went
are computed anew without reading the other periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "bits": F.bitmap_or_agg}


def roll_up(rows: DataFrame, by: Sequence[str], states: Mapping[str, str]) -> DataFrame:
    """One row per group. ``states``: column -> how it merges (``sum``, ``min``, ``max``, ``bits``).

    A count is the sum of a column of ones. Rows may be rolled up already.
    """
    if unknown := set(states.values()) - set(MERGE):
        raise ValueError(f"no way to merge {', '.join(sorted(unknown))}")
    return rows.groupBy(*by).agg(*[MERGE[how](c).cast(rows.schema[c].dataType).alias(c) for c, how in states.items()])


def with_late_rows(stored: DataFrame, late: DataFrame, by: Sequence[str], states: Mapping[str, str]) -> DataFrame:
    """The roll-up after rows were added; ``late`` is rolled up or not. NULL keys are a group."""
    columns = [*by, *states]
    return roll_up(stored.select(*columns).unionByName(late.select(*columns)), by, states)


def with_periods_replaced(stored: DataFrame, fresh: DataFrame, period: str, periods: Sequence[int]) -> DataFrame:
    """The roll-up with some periods from ``fresh``, which has only these; the others stay."""
    chosen = list(periods)
    kept = stored.where(~F.coalesce(F.col(period).isin(chosen), F.lit(False)))
    return kept.unionByName(fresh.where(F.col(period).isin(chosen)).select(*stored.columns))


def replace_periods(fresh: DataFrame, folder: str, period: str, periods: Sequence[int]) -> None:
    """Replace some periods of a stored roll-up that is partitioned by period.

    Only the partitions of these periods are written. A period without rows left keeps none.
    """
    chosen, seen = list(periods), Observation()
    rows = fresh.where(F.col(period).isin(chosen)).observe(seen, F.collect_set(period).alias("present"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(folder)
    spark = fresh.sparkSession
    for gone in set(chosen) - set(seen.get["present"]):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{period}={gone}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
