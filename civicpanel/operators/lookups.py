"""Joins against dimensions, and helpers that keep joins safe on skewed keys.

No join here carries a broadcast hint. Catalyst broadcasts a side whose measured size
is under ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles, and adaptive
execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_state(df: DataFrame, states: DataFrame) -> DataFrame:
    """Ensure ``sigla_uf``: keep it, else map ``cod_uf`` (unknown code gives NULL)."""
    if "sigla_uf" in df.columns:
        return df
    if "cod_uf" not in df.columns:
        raise ValueError("neither sigla_uf nor cod_uf in " + ", ".join(df.columns))
    codes = states.select("cod_uf", "sigla_uf")
    return df.withColumn("cod_uf", F.col("cod_uf").cast("string")).join(codes, "cod_uf", "left")


def map_codes(
    df: DataFrame,
    mapping: DataFrame,
    code: str,
    target: str,
    name: str,
    keep_unknown: bool = False,
) -> DataFrame:
    """Add ``name`` looked up by ``code``; unknown codes give NULL or stay themselves."""
    known = mapping.select(code, F.col(target).alias(name))
    found = df.join(known, code, "left")
    if keep_unknown:
        found = found.withColumn(name, F.coalesce(F.col(name), F.col(code).cast("string")))
    return found


def unmapped(df: DataFrame, column: str) -> DataFrame:
    """Rows whose key could not be resolved, for reporting."""
    return df.where(F.col(column).isNull())


def one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Drop repeated rows; a key with two different value sets is an error.

    One aggregation: equal rows collapse before the shuffle.
    """
    row = F.struct(*values)
    merged = df.groupBy(*keys).agg(F.min(row).alias("lo"), F.max(row).alias("hi"))
    message = F.concat(F.lit("conflicting rows for key "), F.to_json(F.struct(*keys)))
    agreed = F.when(F.col("lo").eqNullSafe(F.col("hi")), F.col("lo")).otherwise(F.raise_error(message))
    return merged.select(*keys, agreed.alias("row")).select(*keys, "row.*")


def with_group_values(df: DataFrame, by: Sequence[str], **values: Column) -> DataFrame:
    """Attach aggregates of each group to its rows; a NULL key gets NULL.

    Aggregate and join back instead of a window: the aggregate combines before its
    shuffle and rows of a hot group need not meet in one task. The null-safe join keeps
    Catalyst from filtering one side only, so both read the same shuffle of ``df``.
    """
    keys = {key: f"_group_{key}" for key in by}
    totals = df.groupBy(*[F.col(k).alias(g) for k, g in keys.items()]).agg(
        *[c.alias(name) for name, c in values.items()]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(g)) for k, g in keys.items()])
    known = reduce(and_, [F.col(k).isNotNull() for k in by])
    return df.join(totals, same, "left").select(
        *df.columns, *[F.when(known, F.col(name)).alias(name) for name in values]
    )


def without_known(found: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key pairs of ``found`` that are not listed in ``known``."""
    return found.select(*keys).distinct().join(known, list(keys), "left_anti")


def missing_years(mapping: DataFrame, first: int, last: int, time: str = "ano") -> DataFrame:
    """Requested years that a mapping does not cover."""
    return requested_years(mapping, first, last, time).join(mapping, time, "left_anti")


def covered_years(mapping: DataFrame, first: int, last: int, time: str = "ano") -> DataFrame:
    """The part of a mapping that covers the requested years."""
    return mapping.where(F.col(time).between(first, last))


def requested_years(df: DataFrame, first: int, last: int, time: str = "ano") -> DataFrame:
    return df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(time))
