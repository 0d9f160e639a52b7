"""Exact distinct counts that add up: bitmaps per group, merged into those of larger groups.

A distinct count cannot be summed; a bitmap of the values can be merged. Values are numbers
without large gaps, such as keys: a value is a bit of the bitmap of its bucket, which has a
fixed size of 4 kB. ``numbered_values`` gives gapless numbers to values of any type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicpanel.sources.scratch import stored

BUCKET, BITS = "balde", "bits"


def bitmap_states(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, balde, bits): which values occur in each group. NULL values do not.

    Bits of one group and bucket are set in each task before they are shuffled, so a group
    with most of the rows costs one bitmap per task and bucket.
    """
    number = F.col(value).cast("long")
    return (
        df.where(number.isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))
    )


def merge_states(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The states of larger groups, or of several runs for the same ones."""
    return states.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_states(states: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct values per group of states, which may be finer than ``by``."""
    merged = merge_states(states, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))


def count_grains(states: DataFrame, grains: Mapping[str, Sequence[str | Column]], name: str, by: Sequence[str] = ()) -> DataFrame:
    """(grao, by, entidade, name): distinct values of each grain, all from one set of states.

    ``grains``: name of a grain -> the column, or a constant, that names its entities. Every
    state is sent to its entity of each grain, and bitmaps are merged before the shuffle.
    """
    places = F.array(*[F.struct(F.lit(g).alias("grao"), _column(c).cast("string").alias("entidade")) for g, c in grains.items()])
    each = states.select(*by, BUCKET, BITS, F.inline(places))
    return count_states(each.where(F.col("entidade").isNotNull()), ["grao", *by, "entidade"], name)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numbered_values(df: DataFrame, value: str, name: str) -> DataFrame:
    """(value, name): the distinct values, not NULL, in order and with gapless numbers from 0.

    The values are range-partitioned and stored with their place in the partition; the rows
    of earlier partitions are added to it. No task holds all values.
    """
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct()
    spread = distinct.repartitionByRange(value).sortWithinPartitions(value).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(spread.withColumn("_part", F.shiftright("_at", 33)), "numbered_values")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row per partition; the window is over these.
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return placed.join(parts, "_part").select(value, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name))
