"""Comparison of entities with each other and with larger groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.functions.expressions import label, safe_ratio
from civicpanel.operators.lookups import with_group_values


def share_of_total(df: DataFrame, by: Sequence[str], value: str = "valor", scale: float = 100.0) -> DataFrame:
    """Replace the value by its share of the group total; a NULL key gives NULL.

    Take shares over all dimensions first and filter or average afterwards.
    """
    total = with_group_values(df, by, _total=F.sum(value))
    return total.withColumn(value, safe_ratio(value, "_total", scale)).drop("_total").select(*df.columns)


def group_mean(df: DataFrame, by: Sequence[str], value: str = "valor", weight: str | None = None) -> DataFrame:
    """Mean per group without NULL keys; every entity counts the same unless weighted."""
    known = df.dropna(subset=list(by))
    if weight is None:
        return known.groupBy(*by).agg(F.avg(value).alias(value))
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    return known.groupBy(*by).agg(safe_ratio(F.sum(F.col(value) * w), F.sum(w)).alias(value))


def expand_entities(
    df: DataFrame,
    entities: DataFrame,
    key: str = "sigla_uf",
    name: str = "nome_uf",
    group: str = "regiao",
    by: Sequence[str] = ("ano", "dimensao"),
    value: str = "valor",
) -> DataFrame:
    """(by, value, entidade) at three grains: entity, mean of its group, mean of all.

    Entity rows are passed through, not aggregated. Both means come from one pass with
    grouping sets. An entity without a group counts in the overall mean only. NULL keys
    are dropped from the means after grouping: a filter before it would reach the source
    of one branch only, and the two would no longer share their input's shuffle.
    """
    base = df.join(entities.select(key, name, group), key, "left")
    own = base.select(*by, value, F.col(name).alias("entidade"))
    means = (
        base.groupingSets([[*by, group], [*by]], *by, group)
        .agg(F.avg(value).alias(value), F.grouping(group).alias("_all"))
        .where((F.col("_all") == 1) | F.col(group).isNotNull())
        .dropna(subset=list(by))
        .select(
            *by,
            value,
            F.when(F.col("_all") == 1, F.lit(fv.COUNTRY_ENTITY))
            .otherwise(label(fv.REGION_PREFIX, F.col(group)))
            .alias("entidade"),
        )
    )
    return own.unionByName(means)


def focus_series(
    df: DataFrame,
    entities: DataFrame,
    focus: str,
    extras: Sequence[str] = (),
    key: str = "sigla_uf",
    name: str = "nome_uf",
    group: str = "regiao",
    time: str = "ano",
    value: str = "valor",
) -> DataFrame:
    """(time, value, serie): the focus entity, its group's mean, the overall mean, extras.

    Every row is labelled once with the series it belongs to, its own if it is chosen and
    the means, and one aggregation gives both: rows of chosen entities pass through it as
    they are, means leave out NULL times.
    """
    names = entities.select(key, name, group)
    own_group = names.where(F.col(key) == focus).select(F.col(group).alias("_focus_group")).distinct()
    placed = names.join(own_group, F.col(group) == F.col("_focus_group"), "left")
    chosen = [focus, *[e for e in extras if e != focus]]
    own = F.when(F.col(key).isin(chosen), F.struct(F.lit(True).alias("own"), F.col(name).alias("serie")))
    means = [
        F.when(title.isNotNull() & F.col(time).isNotNull(), F.struct(F.lit(False).alias("own"), title.alias("serie")))
        for title in (label(fv.MEAN_PREFIX, F.col("_focus_group")), F.lit(fv.COUNTRY_SERIES))
    ]
    labelled = df.join(placed, key, "left").select(
        time, value, F.inline(F.array_compact(F.array(own, *means)))
    )
    row = F.struct(F.col(value).alias(value))
    series = labelled.groupBy(time, "own", "serie").agg(
        F.avg(F.when(~F.col("own"), F.col(value))).alias("_mean"),
        F.collect_list(F.when(F.col("own"), row)).alias("_rows"),
    )
    found = F.when(F.col("own"), F.col("_rows")).otherwise(F.array(F.struct(F.col("_mean").alias(value))))
    return series.select(time, "serie", F.inline(found)).select(time, value, "serie")


def selected_indicators(fact: DataFrame, catalogue: DataFrame, names: Sequence[str]) -> DataFrame:
    """General series of the chosen indicators with name and unit.

    Indicators with sub-dimensions cannot be chosen. One join, no loop; on the stored
    fact table the join prunes partitions at run time.
    """
    chosen = catalogue.where(
        F.col("nome").isin(list(names)) & ~F.col("id_indicador").isin(list(fv.WITH_DIMENSIONS))
    ).select("id_indicador", F.col("nome").alias("indicador_nome"), "unidade")
    return fact.where(F.col("dimensao") == "").join(chosen, "id_indicador")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-empty values."""
    return df.where(F.col(column) != "").select(column).distinct().orderBy(column)


def distinct_combinations(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
