"""Joins of moments with intervals, by time bins: equality on the bin, the exact test after.

An interval is cut at the borders of bins of equal length and so has one row per bin that it
touches, not one per day; a moment has one bin. Both meet by an equi-join on key and bin, and
no key's intervals are compared with all its moments. Bins about as long as a usual interval
give few rows per interval and few intervals per bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.operators.history import scanned

SECONDS_PER_DAY = 86_400


def bin_of(moment: str | Column, days: int) -> Column:
    """Number of the bin of a date or timestamp."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(days)).cast("int")


def in_bins(intervals: DataFrame, start: str, end: str, days: int, name: str = "_bin") -> DataFrame:
    """One row per bin of each interval; intervals without a start or an end, or that end before they start, have none."""
    proper = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    return proper.select("*", F.explode(F.sequence(bin_of(start, days), bin_of(end, days))).alias(name))


def assign_intervals(
    moments: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    moment: str,
    start: str,
    end: str,
    keep: Sequence[str],
    days: int,
    how: str = "left",
) -> DataFrame:
    """Moments with the columns ``keep`` of each interval of their keys that they fall in, ends included.

    ``how``: ``left`` keeps moments in no interval, ``inner`` drops them. A moment in several
    intervals has a row for each; ``overlaps`` finds these. Dates end with their last second
    only if they are compared with dates: cast the moment to the type of the ends.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown how {how!r}")
    binned = in_bins(intervals.select(*keys, start, end, *keep), start, end, days)
    theirs = binned.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col(start).alias("_start"), F.col(end).alias("_end"), "_bin",
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    )
    mine = moments.withColumn("_at", bin_of(moment, days))
    matched = (F.col("_at") == F.col("_bin")) & F.col(moment).between(F.col("_start"), F.col("_end"))
    for k in keys:
        matched &= F.col(k) == F.col(f"_of_{k}")
    return mine.join(theirs, matched, how).select(*moments.columns, *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)])


def overlaps(intervals: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Intervals that begin before one of the same keys that began earlier has ended, with that end (``fim_anterior``).

    By a running maximum of ends, which a key with any number of intervals shares over tasks.
    """
    proper = intervals.where(F.col(start).isNotNull() & (F.col(start) <= F.col(end)))
    seen = scanned(proper, keys, [start, end], maxima={"fim_anterior": end})
    return seen.where(F.col(start) <= F.col("fim_anterior"))
