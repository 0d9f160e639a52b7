"""Year-lagged pairing and grouped Pearson correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.expressions import is_value, round_half_even


def lagged_pairs(cause: DataFrame, effect: DataFrame, on: Sequence[str], time: str, lag: int) -> DataFrame:
    """Cause of year t joined with the effect of year t + lag.

    One join gives every cause x effect combination of an entity; the other columns of
    both sides say which.
    """
    shifted = cause.withColumn(time, F.col(time) + F.lit(lag))
    return shifted.join(effect, [*on, time], "inner")


def pearson_by(
    pairs: DataFrame, by: Sequence[str], x: str, y: str, min_n: int = 3, digits: int | None = 3
) -> DataFrame:
    """(by, correlacao, n) for groups of at least ``min_n`` rows.

    n counts rows, the coefficient uses complete pairs. A constant series keeps its
    row with a NULL coefficient; the built-in ``corr`` would raise there.
    """
    complete = is_value(x) & is_value(y)
    xs, ys = (F.when(complete, F.col(c).cast("double")) for c in (x, y))
    r = F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    return (
        pairs.groupBy(*by)
        .agg((r if digits is None else round_half_even(r, digits)).alias("correlacao"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_n)
    )
