"""Row filters with optional parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.expressions import is_value


def in_years(df: DataFrame, time: str, first: int, last: int) -> DataFrame:
    return df.where(F.col(time).between(first, last))


def keep_members(df: DataFrame, column: str, members: Sequence | None) -> DataFrame:
    """Keep listed members; no list, or an empty one, keeps everything."""
    return df.where(F.col(column).isin(list(members))) if members else df


def drop_members(df: DataFrame, column: str, members: Sequence) -> DataFrame:
    return df.where(~F.col(column).isin(list(members)))


def choose_dimension(df: DataFrame, dimension: str, chosen: str | None = None) -> DataFrame:
    """None keeps all rows, "" keeps the general series, a label keeps that one."""
    return df if chosen is None else df.where(F.col(dimension) == chosen)


def has_values(df: DataFrame, value: str) -> bool:
    """False for an empty frame or one whose values are all missing."""
    return not df.where(is_value(value)).select(value).isEmpty()
