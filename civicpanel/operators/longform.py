"""The common long form (ano, sigla_uf, id_indicador, dimensao, valor)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.functions.expressions import is_value, require

LONG_COLUMNS = ["ano", "sigla_uf", "id_indicador", "dimensao", "valor"]


def to_long(
    df: DataFrame,
    indicator: str,
    value: str,
    time: str = "ano",
    entity: str = "sigla_uf",
    dimension: str | Column = "",
) -> DataFrame:
    """One measure as long rows. A text ``dimension`` is constant, a column is per row.

    Rows without a value are dropped, and so are rows whose dimension column is NULL.
    """
    per_row = isinstance(dimension, Column)
    long = df.select(
        F.col(time).alias("ano"),
        F.col(entity).alias("sigla_uf"),
        F.lit(indicator).alias("id_indicador"),
        (dimension if per_row else F.lit(dimension)).alias("dimensao"),
        F.col(value).cast("double").alias("valor"),
    ).where(is_value("valor"))
    return long.where(F.col("dimensao").isNotNull()) if per_row else long


def measures_to_long(
    df: DataFrame,
    measures: Mapping[str, tuple[str, str]],
    time: str = "ano",
    entity: str = "sigla_uf",
) -> DataFrame:
    """Several measures of one table in one pass (column -> (indicator id, dimension)).

    Measures of one indicator keep its id as a literal, so that a filter on another id
    drops the whole branch from the plan.
    """
    ids = {indicator for indicator, _ in measures.values()}
    shared = [F.lit(i).alias("id_indicador") for i in ids] if len(ids) == 1 else []
    rows = []
    for column, (indicator, dimension) in measures.items():
        own = [] if shared else [F.lit(indicator).alias("id_indicador")]
        value = F.col(column).cast("double").alias("valor")
        rows.append(F.struct(*own, F.lit(dimension).alias("dimensao"), value))
    keys = [F.col(time).alias("ano"), F.col(entity).alias("sigla_uf")]
    long = df.select(*keys, *shared, F.inline(F.array(*rows)))
    return long.where(is_value("valor")).select(*LONG_COLUMNS)


def unpivot_measures(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Measure columns to rows, relabelled (``measures``: column -> label)."""
    relabelled = df.select(*keys, *[F.col(c).alias(label) for c, label in measures.items()])
    return relabelled.unpivot(list(keys), list(measures.values()), name, value).where(is_value(value))


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of long parts; a row without a year is an error."""
    if not parts:
        raise ValueError("no indicator to consolidate")
    whole = reduce(DataFrame.unionByName, parts)
    return whole.withColumn("ano", require(F.col("ano").cast("int"), "fact row without a year"))


def rows_per_indicator(fact: DataFrame) -> DataFrame:
    return fact.groupBy("id_indicador").agg(F.count(F.lit(1)).alias("linhas"))
