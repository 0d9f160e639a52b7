"""The two comparison reports, as frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.functions.expressions import label
from civicpanel.operators.association import lagged_pairs, pearson_by
from civicpanel.operators.compare import (
    distinct_values,
    expand_entities,
    focus_series,
    selected_indicators,
    share_of_total,
)
from civicpanel.operators.filters import choose_dimension, drop_members, has_values, keep_members
from civicpanel.operators.panel_regression import fixed_effects
from civicpanel.operators.tenure import term_bands
from civicpanel.sources.tables import indicator_slice


def state_series(
    fact: DataFrame,
    states: DataFrame,
    indicator: str,
    focus: str,
    dimension: str | None = None,
    as_share: bool = False,
    extras: Sequence[str] = (),
) -> DataFrame:
    """(ano, valor, serie) of one indicator: a state, its region, the country, extras.

    The share is taken over all dimensions before one of them is chosen.
    """
    rows = indicator_slice(fact, indicator)
    if as_share:
        rows = share_of_total(rows, ["ano", "sigla_uf"])
    return focus_series(choose_dimension(rows, "dimensao", dimension), states, focus, extras)


def state_report(series: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The series of a state in the order of the chart and of the table; None if no value was found."""
    if not has_values(series, "valor"):
        return None
    return chart_order(series), table_order(series)


def chart_order(series: DataFrame) -> DataFrame:
    return series.orderBy("serie", "ano")


def table_order(series: DataFrame) -> DataFrame:
    return series.orderBy("ano", "serie")


def state_terms(terms: DataFrame, focus: str | None) -> DataFrame:
    return term_bands(terms, focus)


def detail_options(fact: DataFrame, indicator: str) -> DataFrame:
    """Sub-dimensions that an indicator can be looked at by; empty for one without."""
    return distinct_values(indicator_slice(fact, indicator), "dimensao")


def other_states(fact: DataFrame, indicator: str, focus: str) -> DataFrame:
    """States with rows of an indicator that the chosen one can be compared with."""
    rows = indicator_slice(fact, indicator).where(F.col("sigla_uf") != focus)
    return distinct_values(rows, "sigla_uf")


def entity_options(states: DataFrame) -> DataFrame:
    """Names that can be compared: states, then regions, then the country."""
    names = states.select(F.lit(1).alias("grupo"), F.col("nome_uf").alias("entidade"))
    regions = states.select(F.lit(2).alias("grupo"), label(fv.REGION_PREFIX, F.col("regiao")).alias("entidade"))
    country = states.select(F.lit(3).alias("grupo"), F.lit(fv.COUNTRY_ENTITY).alias("entidade"))
    options = names.unionByName(regions).unionByName(country).dropna().distinct()
    return options.orderBy("grupo", "entidade")


def function_options(fact: DataFrame) -> DataFrame:
    return detail_options(fact, fv.SPENDING_ID)


def indicator_options(catalogue: DataFrame) -> DataFrame:
    """Indicators without sub-dimensions, the ones that can be set against spending."""
    return drop_members(catalogue, "id_indicador", fv.WITH_DIMENSIONS)


def spending_rows(fact: DataFrame, functions: Sequence[str] | None, as_share: bool) -> DataFrame:
    """Spending (ano, sigla_uf, dimensao, valor) of the functions, absolute or as share."""
    rows = indicator_slice(fact, fv.SPENDING_ID)
    if as_share:
        rows = share_of_total(rows, ["ano", "sigla_uf"])
    return keep_members(rows, "dimensao", functions)


def spending_series(
    fact: DataFrame,
    states: DataFrame,
    functions: Sequence[str] | None = None,
    entities: Sequence[str] | None = None,
    as_share: bool = False,
    lag: int = 0,
) -> DataFrame:
    """Spending at all three grains, with the year it is shown at under the lag."""
    grains = expand_entities(spending_rows(fact, functions, as_share), states)
    return (
        keep_members(grains, "entidade", entities)
        .withColumn("serie", label(F.col("entidade"), fv.SERIES_SEPARATOR, F.col("dimensao")))
        .withColumn("ano_exibido", F.col("ano") + F.lit(lag))
    )


def outcome_series(
    fact: DataFrame,
    states: DataFrame,
    catalogue: DataFrame,
    names: Sequence[str],
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """The chosen indicators at all three grains, with name and unit."""
    chosen = selected_indicators(fact, catalogue, names)
    grains = expand_entities(chosen, states, by=("ano", "indicador_nome", "unidade"))
    return keep_members(grains, "entidade", entities).withColumn(
        "serie", label(F.col("entidade"), fv.SERIES_SEPARATOR, F.col("indicador_nome"))
    )


def correlations(spending: DataFrame, outcomes: DataFrame, lag: int = 0) -> DataFrame:
    """Pearson r of every entity x function x indicator with three common years or more."""
    pairs = lagged_pairs(
        spending.select("entidade", "ano", F.col("dimensao").alias("funcao"), F.col("valor").alias("despesa")),
        outcomes.select("entidade", "ano", "indicador_nome", F.col("valor").alias("indicador")),
        ["entidade"],
        "ano",
        lag,
    )
    return pearson_by(pairs, ["entidade", "funcao", "indicador_nome"], "despesa", "indicador")


def regressions(
    fact: DataFrame,
    catalogue: DataFrame,
    names: Sequence[str],
    functions: Sequence[str] | None = None,
    as_share: bool = False,
    lag: int = 0,
) -> DataFrame:
    """Fixed-effects slope of every function x indicator, always over all states.

    Rows of an unknown state match nothing below; dropping them first lets all readers
    of the fact share its plan.
    """
    fact = fact.where(F.col("sigla_uf").isNotNull())
    spending = spending_rows(fact, functions, as_share)
    outcomes = selected_indicators(fact, catalogue, names)
    panel = lagged_pairs(
        spending.select("sigla_uf", "ano", F.col("dimensao").alias("funcao"), F.col("valor").alias("despesa")),
        outcomes.select("sigla_uf", "ano", "indicador_nome", F.col("valor").alias("indicador")),
        ["sigla_uf"],
        "ano",
        lag,
    )
    return fixed_effects(panel, ["funcao", "indicador_nome"], "sigla_uf", "ano", "despesa", "indicador")
