"""The published sub-indicators, from raw tables to per-indicator tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.functions.expressions import (
    code_between,
    died_under_one,
    period_year,
    safe_ratio,
    subtotal_code,
)
from civicpanel.operators.filters import in_years, keep_members
from civicpanel.operators.lookups import one_per_key
from civicpanel.operators.measures import (
    count_by,
    increments,
    mean_with_count,
    rate,
    rate_or_zero,
    sum_by,
    weighted_mean,
)
from civicpanel.operators.tenure import add_term_dates, flag_conflicts, latest_per_key, unknown_conflicts
from civicpanel.sources.frames import literal_frame
from civicpanel.sources.nested import flatten_periods, flatten_series, flatten_series_by_class

STATE_YEAR = ["ano", "sigla_uf"]


def gdp_per_capita(gdp: DataFrame, population: DataFrame) -> DataFrame:
    """GDP in thousands and population, both (ano, cod_uf, uf, value), in currency per head."""
    joined = gdp.join(population, ["ano", "cod_uf", "uf"])
    per_head = safe_ratio(F.col("pib_mil_reais") * 1000, "populacao")
    return joined.withColumn("pib_per_capita_reais", per_head)


def state_population(per_capita: DataFrame, states: DataFrame) -> DataFrame:
    """(ano, sigla_uf, populacao), one row per key, from the per-head table."""
    unique = one_per_key(per_capita, ["ano", "cod_uf"], ["populacao"])
    return unique.join(states.select("cod_uf", "sigla_uf"), "cod_uf", "left").select(
        "ano", "sigla_uf", "populacao"
    )


def gini(blocks: DataFrame) -> DataFrame:
    return flatten_series(blocks, "indice_gini")


def development_index(source: DataFrame) -> DataFrame:
    return source.where(F.col("idhm").isNotNull()).select(
        "ano",
        "sigla_uf",
        "idhm",
        F.col("idhm_e").alias("idhm_educacao"),
        F.col("idhm_l").alias("idhm_longevidade"),
        F.col("idhm_r").alias("idhm_renda"),
    )


def spending_by_function(
    spending: DataFrame,
    first: int,
    last: int,
    stage: str = fv.SETTLED_SPENDING,
    functions: Sequence[str] | None = None,
    by_code: bool = False,
) -> DataFrame:
    """Spending per state, year, function and stage.

    Functions are grouped by label, so one code under two labels gives two functions;
    ``by_code`` groups by code instead.
    """
    rows = in_years(spending, "ano", first, last).where(
        (F.col("estagio_bd") == stage)
        & subtotal_code("id_conta_bd", fv.FUNCTION_TOTALS, fv.ALL_FUNCTIONS)
    )
    names = rows.withColumnsRenamed({"sigla_uf": "uf", "conta_bd": "funcao", "estagio_bd": "estagio"})
    chosen = keep_members(names, "funcao", [f.strip() for f in functions] if functions else None)
    function = "id_conta_bd" if by_code else "funcao"
    return sum_by(chosen, ["ano", "uf", function, "estagio"], "valor", "valor_reais")


def unemployment(blocks: DataFrame) -> DataFrame:
    """Mean of the quarters that exist in a year, and their number."""
    quarters = flatten_periods(blocks, "taxa").withColumn("ano", period_year("periodo"))
    return mean_with_count(
        quarters, ["ano", "cod_uf", "uf"], "taxa", "taxa_desocupacao_media_anual", "trimestres_disponiveis"
    )


def _per_population(
    counts: DataFrame, population: DataFrame | None, count: str, scale: float, name: str
) -> DataFrame:
    """Counts with population and rate; both NULL when there is no population table."""
    if population is None:
        nothing = F.lit(None).cast("double")
        return counts.withColumn("populacao", nothing).withColumn(name, nothing)
    return rate(counts, population, STATE_YEAR, count, "populacao", scale, name)


def formal_employment(
    links: DataFrame, population: DataFrame | None, first: int, last: int, count: str | None = None
) -> DataFrame:
    """Active links per 1,000 people; ``count`` says how many links a row stands for."""
    active = in_years(links, "ano", first, last).where(F.col("vinculo_ativo_3112") == fv.ACTIVE_LINK)
    counts = count_by(active, STATE_YEAR, "vinculos_ativos", count)
    return _per_population(counts, population, "vinculos_ativos", 1000, "vinculos_por_mil_habitantes")


def deforestation(source: DataFrame, municipalities: DataFrame, first: int, last: int) -> DataFrame:
    """Yearly increase of the cleared area per state, from a cumulative measure."""
    steps = increments(source, ["id_municipio", "bioma"], "ano", "desmatado", "passo", first, last)
    placed = steps.join(municipalities.select("id_municipio", "sigla_uf"), "id_municipio")
    return sum_by(placed, STATE_YEAR, "passo", "area_desmatada_incremento_km2")


def infant_mortality_official(blocks: DataFrame) -> DataFrame:
    return flatten_series_by_class(blocks, "taxa_mortalidade_infantil_oficial", fv.YEAR_CLASSIFICATION)


def infant_mortality_raw(deaths: DataFrame, births: DataFrame, first: int, last: int) -> DataFrame:
    """Registered infant deaths per 1,000 live births; under-registered, not for the fact table."""
    infants = in_years(deaths, "ano", first, last).where(
        (F.col("tipo_obito") == fv.LIVE_BIRTH_DEATH) & died_under_one("idade", "data_nascimento", "data_obito")
    )
    return rate_or_zero(
        count_by(infants, STATE_YEAR, "obitos_infantis"),
        count_by(in_years(births, "ano", first, last), STATE_YEAR, "nascidos_vivos"),
        STATE_YEAR,
        "obitos_infantis",
        "nascidos_vivos",
        1000,
        "taxa_mortalidade_infantil",
    )


def school_index(source: DataFrame, first: int, last: int) -> DataFrame:
    return (
        in_years(source, "ano", first, last)
        .where((F.col("rede") == fv.STATE_NETWORK) & F.col("ideb").isNotNull())
        .select("ano", "sigla_uf", "ensino", "anos_escolares", "ideb", "taxa_aprovacao")
    )


def homicide_rate(
    deaths: DataFrame, population: DataFrame | None, first: int, last: int, count: str | None = None
) -> DataFrame:
    """Deaths by assault per 100,000 people; ``count`` says how many deaths a row stands for."""
    killed = in_years(deaths, "ano", first, last).where(
        (F.col("tipo_obito") == fv.LIVE_BIRTH_DEATH) & code_between("causa_basica", *fv.HOMICIDE_CAUSES)
    )
    counts = count_by(killed, STATE_YEAR, "obitos_homicidio", count)
    return _per_population(counts, population, "obitos_homicidio", 100_000, "taxa_homicidios_100mil")


def sanitation(source: DataFrame, first: int, last: int, null_policy: str = "as_zero") -> DataFrame:
    """Water and sewage coverage weighted by urban population, in one aggregation."""
    return weighted_mean(
        in_years(source, "ano", first, last),
        STATE_YEAR,
        {
            "taxa_atendimento_agua": "indice_atendimento_total_agua",
            "taxa_atendimento_esgoto": "indice_coleta_esgoto",
        },
        "populacao_urbana",
        null_policy,
    )


def governors(results: DataFrame, first: int, last: int) -> DataFrame:
    """Elected governors with term dates; pairs with two people are flagged instead."""
    elected = (
        in_years(results, "ano", first, last)
        .where((F.col("cargo") == fv.OFFICE) & (F.col("resultado") == fv.ELECTED))
        .select(F.col("ano").alias("ano_eleicao"), "sigla_uf", "turno", "nome_candidato", "sigla_partido")
    )
    last_round = latest_per_key(
        elected, ["ano_eleicao", "sigla_uf", "nome_candidato", "sigla_partido"], ["turno"]
    )
    flagged = flag_conflicts(last_round, ["ano_eleicao", "sigla_uf"], "nome_candidato", "requer_revisao_manual")
    dated = add_term_dates(flagged, "ano_eleicao", "requer_revisao_manual", "inicio_mandato", "fim_mandato")
    return dated.select(
        "ano_eleicao",
        "sigla_uf",
        "nome_candidato",
        "sigla_partido",
        "inicio_mandato",
        "fim_mandato",
        "requer_revisao_manual",
    )


def unlisted_double_terms(terms: DataFrame) -> DataFrame:
    """Flagged (election, state) pairs outside the known cases."""
    known = literal_frame(terms.sparkSession, fv.KNOWN_DOUBLE_TERMS, "ano_eleicao INT, sigla_uf STRING")
    return unknown_conflicts(terms, known, ["ano_eleicao", "sigla_uf"], "requer_revisao_manual")
