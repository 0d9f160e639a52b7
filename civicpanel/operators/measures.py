"""Measures per entity and period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicpanel.functions.expressions import at_least, is_value, safe_ratio
from civicpanel.operators.lookups import one_per_key


def count_by(df: DataFrame, by: Sequence[str], name: str, count: str | None = None) -> DataFrame:
    """Row count per group; groups without rows are absent.

    ``count`` names a column that says how many rows a pre-counted row stands for.
    """
    rows = F.count(F.lit(1)) if count is None else F.sum(count).cast("long")
    return df.groupBy(*by).agg(rows.alias(name))


def sum_by(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(name))


def mean_with_count(
    df: DataFrame, by: Sequence[str], value: str, mean: str, count: str, **more: Column
) -> DataFrame:
    """Mean of the periods that exist, and how many there were; NULL keys have no group.

    ``more``: further aggregates of the same pass.
    """
    extra = [c.alias(name) for name, c in more.items()]
    known = df.dropna(subset=list(by))
    return known.groupBy(*by).agg(F.avg(value).alias(mean), F.count(value).alias(count), *extra)


def weighted_mean(
    df: DataFrame,
    by: Sequence[str],
    values: Mapping[str, str],
    weight: str,
    null_policy: str = "as_zero",
) -> DataFrame:
    """Weighted means of several values in one aggregation (``values``: name -> column).

    Rows without a positive weight, or with a NaN one, are dropped. Under ``as_zero`` a missing value keeps
    its weight in the denominator, so the result is biased low; under ``exclude`` its
    weight is left out.
    """
    if null_policy not in ("as_zero", "exclude"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    w = F.col(weight)
    means = []
    for name, value in values.items():
        counted = w if null_policy == "as_zero" else F.when(F.col(value).isNotNull(), w)
        means.append(safe_ratio(F.sum(F.col(value) * w), F.sum(counted)).alias(name))
    return df.where(is_value(w) & (w > 0)).groupBy(*by).agg(*means)


def rate(
    num: DataFrame,
    den: DataFrame,
    on: Sequence[str],
    num_col: str,
    den_col: str,
    scale: float,
    name: str,
    how: str = "left",
) -> DataFrame:
    """num / den x scale. Left join: no denominator gives a NULL rate.

    Repeated denominator rows are merged; two different values for a key raise. Rows
    without a key, such as those of an unknown state code, match nothing.
    """
    unique = one_per_key(den.dropna(subset=list(on)), on, [den_col])
    return num.join(unique, list(on), how).withColumn(name, safe_ratio(num_col, den_col, scale))


def rate_or_zero(
    num: DataFrame,
    den: DataFrame,
    on: Sequence[str],
    num_col: str,
    den_col: str,
    scale: float,
    name: str,
) -> DataFrame:
    """The denominator drives: keys without a numerator count 0, the others are lost."""
    joined = den.join(num, list(on), "left")
    return joined.withColumn(num_col, F.coalesce(F.col(num_col), F.lit(0))).withColumn(
        name, safe_ratio(num_col, den_col, scale)
    )


def increments(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    name: str,
    first: int | None = None,
    last: int | None = None,
) -> DataFrame:
    """Step increases of a cumulative series, (keys, time, name).

    A row counts only if the same key has a value exactly one step earlier; decreases
    are clamped to 0; a missing value gives a NULL increment. With ``first``, the step
    before it is read as a base and not reported.

    Only the row one step back matters, so each row is sent to its own step and, as
    "previous", to the next one, and both meet in one aggregation on (keys, time). That
    spreads a key with a long history over many tasks, which a lag over the key cannot.
    Repeated (key, time) rows act as a lag ordered by time and value would: the lowest
    is compared with the highest of the step before.
    """
    t, v = F.col(time), F.col(value)
    rows = df.where(t.isNotNull())
    if first is not None:
        rows = rows.where(t >= first - 1)
    if last is not None:
        rows = rows.where(t <= last)
    nothing = F.lit(None).cast(dict(df.dtypes)[value])
    # seen: 0 only as previous, 1 here with a value, 2 here without one.
    as_current = F.struct(
        t.alias(time), v.alias("_now"), nothing.alias("_before"), F.when(v.isNull(), 2).otherwise(1).alias("_seen")
    )
    as_previous = F.struct(
        (t + 1).alias(time), nothing.alias("_now"), v.alias("_before"), F.lit(0).alias("_seen")
    )
    pairs = rows.select(*keys, F.inline(F.array(as_current, as_previous)))
    steps = pairs.groupBy(*keys, time).agg(
        F.min("_now").alias("_now"), F.max("_before").alias("_before"), F.max("_seen").alias("_seen")
    )
    kept = steps.where((F.col("_seen") > 0) & F.col("_before").isNotNull())
    if first is not None:
        kept = kept.where(F.col(time) >= first)
    step = F.when(F.col("_seen") == 1, at_least(F.col("_now") - F.col("_before")))
    return kept.select(*keys, time, step.alias(name))


def previous_step(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Each row with the value and time of the row before it and a status.

    Both lags share one window. A key's group is its history: aggregate to one row per
    (key, time) first, which bounds it by the number of periods.
    """
    window = Window.partitionBy(*keys).orderBy(time, value)
    before, at = F.lag(value).over(window), F.lag(time).over(window)
    status = (
        F.when(F.col("tempo_anterior").isNull(), "first")
        .when(F.col("tempo_anterior") != F.col(time) - 1, "gap")
        .when(F.col("valor_anterior").isNull() | F.col(value).isNull(), "missing")
        .when(F.col(value) < F.col("valor_anterior"), "decrease")
        .otherwise("kept")
    )
    return (
        df.withColumn("valor_anterior", before)
        .withColumn("tempo_anterior", at)
        .withColumn("situacao", status)
    )
