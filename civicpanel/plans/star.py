"""Consolidation of per-indicator tables into the fact table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.functions.expressions import label
from civicpanel.operators.longform import measures_to_long, rows_per_indicator, stack, to_long
from civicpanel.operators.lookups import resolve_state
from civicpanel.sources.frames import indicator_dim, state_dim
from civicpanel.sources.rejects import read_good_indicators
from civicpanel.sources.tables import read_indicator_csvs, write_star

# Fixed values. Tables whose measures are columns: stored name -> column -> (indicator id, dimension).
MEASURES = {
    "pib_per_capita_uf": {"pib_per_capita_reais": ("1_pib_per_capita", "")},
    "gini_uf": {"indice_gini": ("2_gini", "")},
    "idhm_uf": {
        "idhm": ("3_idhm", ""),
        "idhm_educacao": ("3_idhm", "educacao"),
        "idhm_longevidade": ("3_idhm", "longevidade"),
        "idhm_renda": ("3_idhm", "renda"),
    },
    "taxa_desocupacao_uf": {"taxa_desocupacao_media_anual": ("5a_taxa_desocupacao", "")},
    "emprego_formal_uf": {"vinculos_por_mil_habitantes": ("5b_emprego_formal", "")},
    "desmatamento_uf": {"area_desmatada_incremento_km2": ("6_desmatamento", "")},
    "mortalidade_infantil_uf_oficial": {
        "taxa_mortalidade_infantil_oficial": ("7_mortalidade_infantil", "")
    },
    "taxa_homicidios_uf": {"taxa_homicidios_100mil": ("9_taxa_homicidios", "")},
    "saneamento_uf": {
        "taxa_atendimento_agua": ("10a_saneamento_agua", ""),
        "taxa_atendimento_esgoto": ("10b_saneamento_esgoto", ""),
    },
}


def spending_part(table: DataFrame) -> DataFrame:
    """Spending rows; this table holds the state abbreviation under ``uf``."""
    return to_long(
        table.withColumnsRenamed({"uf": "sigla_uf"}), fv.SPENDING_ID, "valor_reais", dimension=F.col("funcao")
    )


def school_part(table: DataFrame) -> DataFrame:
    stage = label(F.col("ensino"), "_", F.col("anos_escolares"))
    return to_long(table, "8_ideb", "ideb", dimension=stage)


def consolidate(tables: Mapping[str, DataFrame], states: DataFrame) -> DataFrame:
    """All indicator tables that are present as one fact table; none at all is an error."""
    parts = [
        measures_to_long(resolve_state(tables[name], states), measures)
        for name, measures in MEASURES.items()
        if name in tables
    ]
    for name, part in (("despesas_funcao_uf", spending_part), ("ideb_uf", school_part)):
        if name in tables:
            parts.append(part(resolve_state_or_same(tables[name], states)))
    return stack(parts)


def resolve_state_or_same(table: DataFrame, states: DataFrame) -> DataFrame:
    return resolve_state(table, states) if {"sigla_uf", "cod_uf"} & set(table.columns) else table


@dataclass(frozen=True)
class Consolidation:
    """The star tables of a folder of indicator tables, and the inputs it lacks."""

    fact: DataFrame
    states: DataFrame
    indicators: DataFrame
    terms: DataFrame | None
    absent: list[str]
    #: (tabela, arquivo, linha) of lines that were left out, if that was asked for.
    rejects: DataFrame | None = None

    def counts(self) -> DataFrame:
        """(tabela, linhas) of all four tables; the term table only if there is one."""
        return dry_run(
            {
                "fato_indicador": self.fact,
                "dim_estado": self.states,
                "dim_indicador": self.indicators,
                "dim_governador": self.terms,
            }
        )

    def counts_by_indicator(self) -> DataFrame:
        return dry_run_by_indicator(self.fact)

    def write(self, folder: str) -> list[str]:
        return write_star(folder, self.fact, self.states, self.indicators, self.terms)


def consolidate_folder(spark: SparkSession, folder: str, on_bad: str = "fail") -> Consolidation:
    """Read the indicator tables of a folder into a star schema; ``write`` is left to the caller.

    ``on_bad``: a line that does not fit its table ends the job (``fail``), or is left out and
    reported in ``rejects`` (``reject``).
    """
    if on_bad not in ("fail", "reject"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    rejects = None
    if on_bad == "fail":
        tables, absent = read_indicator_csvs(spark, folder)
    else:
        tables, rejects, absent = read_good_indicators(spark, folder)
    states = state_dim(spark)
    terms = tables.pop("governadores_uf", None)
    return Consolidation(consolidate(tables, states), states, indicator_dim(spark), terms, absent, rejects)


def dry_run(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(tabela, linhas) of what would be written; writes nothing."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, table in tables.items()
        if table is not None
    ]
    return reduce(DataFrame.unionByName, counts)


def dry_run_by_indicator(fact: DataFrame) -> DataFrame:
    return rows_per_indicator(fact)
