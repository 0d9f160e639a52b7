"""Running sums and previous rows of long histories, however many rows one key has.

Rows are range-partitioned by key and time, so a key with most of the rows is cut into slices
on many tasks. Each slice is scanned by itself; then the totals and the last row of every slice,
one row per key and partition, are carried to the slices after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicpanel.sources.scratch import stored


def scanned(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows with running sums, values of the row before, and maxima of all rows before.

    ``sums``, ``previous`` and ``maxima`` map a new column to the one it is made of. Sums
    include the row itself, NULLs left out; they are NULL until the first value. Rows are
    ordered by ``order``, NULLs first; ties are broken by all other columns. NULL keys are a key.
    """
    sums, previous, maxima = dict(sums or {}), dict(previous or {}), dict(maxima or {})
    ties = [c for c, t in df.dtypes if c not in (*keys, *order) and not t.startswith(("map", "variant"))]
    spread = df.repartitionByRange(*keys, *order, *ties).sortWithinPartitions(*keys, *order, *ties)
    spread = spread.withColumn("_at", F.monotonically_increasing_id())
    placed = stored(spread.withColumn("_part", F.shiftright("_at", 33)), "history")
    slice_ = Window.partitionBy(*keys, "_part").orderBy("_at")
    so_far, before = slice_.rowsBetween(Window.unboundedPreceding, 0), slice_.rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.select(
        "*",
        *[F.sum(c).over(so_far).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.lag(c).over(slice_).alias(f"_before_{n}") for n, c in previous.items()],
        *[F.max(c).over(before).alias(f"_max_{n}") for n, c in maxima.items()],
        (F.row_number().over(slice_) == 1).alias("_first"),
    )
    ends = placed.groupBy(*keys, "_part").agg(
        *[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()],
        *[F.max_by(F.struct(c), "_at").alias(f"_last_{n}") for n, c in previous.items()],
        *[F.max(c).alias(f"_most_{n}") for n, c in maxima.items()],
    )
    # At most one row per partition for a key.
    slices = Window.partitionBy(*keys).orderBy("_part")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col("_part").alias("_of_part"),
        *[F.sum(f"_total_{n}").over(earlier).alias(f"_add_{n}") for n in sums],
        *[F.lag(f"_last_{n}").over(slices)[c].alias(f"_from_{n}") for n, c in previous.items()],
        *[F.max(f"_most_{n}").over(earlier).alias(f"_from_{n}") for n in maxima],
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], F.col("_part") == F.col("_of_part"))
    joined = inside.join(carried, same)
    return joined.select(
        *df.columns,
        *[_both(F.col(f"_sum_{n}"), F.col(f"_add_{n}"), lambda a, b: a + b).alias(n) for n in sums],
        *[F.when(F.col("_first"), F.col(f"_from_{n}")).otherwise(F.col(f"_before_{n}")).alias(n) for n in previous],
        *[F.greatest(f"_max_{n}", f"_from_{n}").alias(n) for n in maxima],
    )


def _both(a: Column, b: Column, joined) -> Column:
    """Both together, or the one that is not NULL."""
    return F.coalesce(joined(a, b), a, b)
