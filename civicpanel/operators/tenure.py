"""Terms of office: who was elected, when the term runs, which year belongs to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicpanel.functions.expressions import name_and_party, term_end, term_start
from civicpanel.operators.lookups import one_per_key, with_group_values, without_known


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that sorts last by ``order``; ties go to the greatest row.

    A ranking filter of this form is cut to one row per key before the shuffle, so a
    hot key costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def flag_conflicts(df: DataFrame, by: Sequence[str], person: str, flag: str) -> DataFrame:
    """Mark every row of a group in which more than one non-null person is left."""
    counted = with_group_values(df, by, _people=F.count(person))
    return counted.withColumn(flag, F.coalesce(F.col("_people") > 1, F.lit(False))).drop("_people")


def unknown_conflicts(flagged: DataFrame, known: DataFrame, by: Sequence[str], flag: str) -> DataFrame:
    """Flagged groups that are not on the list of known exceptions."""
    return without_known(flagged.where(flag), known, by)


def add_term_dates(df: DataFrame, election: str, flag: str, start: str, end: str, length: int = 4) -> DataFrame:
    """1 January after the election to 31 December of the last year; NULL when flagged."""
    clear = ~F.col(flag)
    return df.withColumn(start, F.when(clear, term_start(election))).withColumn(
        end, F.when(clear, term_end(election, length))
    )


def clear_terms(
    terms: DataFrame, entity: str | None = None, key: str = "sigla_uf", flag: str = "requer_revisao_manual"
) -> DataFrame:
    """Terms that need no review, of one entity or of all."""
    kept = terms.where(~F.col(flag))
    return kept if entity is None else kept.where(F.col(key) == entity)


def term_bands(
    terms: DataFrame,
    entity: str | None = None,
    key: str = "sigla_uf",
    start: str = "inicio_mandato",
    end: str = "fim_mandato",
    person: str = "nome_candidato",
    party: str = "sigla_partido",
) -> DataFrame:
    """First and last year, label and alternating band (0, 1) of each clear term."""
    order = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_last(), person, party)
    return clear_terms(terms, entity, key).select(
        key,
        F.year(start).alias("ano_inicio"),
        F.year(end).alias("ano_fim"),
        name_and_party(person, party).alias("rotulo"),
        ((F.row_number().over(order) - 1) % 2).alias("faixa"),
    )


def term_years(
    terms: DataFrame,
    keep: Sequence[str],
    key: str = "sigla_uf",
    time: str = "ano",
    start: str = "inicio_mandato",
    end: str = "fim_mandato",
) -> DataFrame:
    """One row per year of each dated term, both end years included."""
    dated = terms.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) >= F.col(start)))
    return dated.select(key, F.explode(F.sequence(F.year(start), F.year(end))).alias(time), *keep)


def assign_term(
    fact: DataFrame,
    terms: DataFrame,
    keep: Sequence[str],
    key: str = "sigla_uf",
    time: str = "ano",
    start: str = "inicio_mandato",
    end: str = "fim_mandato",
) -> DataFrame:
    """Give each fact row the term its year falls in; NULL where there is none.

    The interval is unrolled to years, so this is an equi-join on (entity, year) rather
    than a range comparison within each entity. Two terms in one year of an entity would
    multiply fact rows and are an error; equal rows count once.
    """
    years = term_years(terms.where(F.col(key).isNotNull()), keep, key, time, start, end)
    return fact.join(one_per_key(years, [key, time], keep), [key, time], "left")


def overlapping_years(terms: DataFrame, key: str = "sigla_uf", time: str = "ano") -> DataFrame:
    """Years that fall in more than one term; empty for well-formed terms."""
    return term_years(terms, [], key, time).groupBy(key, time).count().where("count > 1")


def term_change(assigned: DataFrame, by: Sequence[str], time: str = "ano", value: str = "valor") -> DataFrame:
    """Value in the first and last observed year of a term, and the difference."""
    seen = F.when(F.col(value).isNotNull(), F.col(time))
    ends = assigned.groupBy(*by).agg(
        F.min(seen).alias("primeiro_ano"),
        F.max(seen).alias("ultimo_ano"),
        F.min_by(value, seen).alias("valor_inicial"),
        F.max_by(value, seen).alias("valor_final"),
    )
    return ends.withColumn("variacao", F.col("valor_final") - F.col("valor_inicial"))
