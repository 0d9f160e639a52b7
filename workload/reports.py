"""The two comparison reports, on a fact table derived from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.operators import compare
from civicpanel.plans import pages
from civicpanel.sources.frames import indicator_dim
from civicpanel.sources.tables import indicator_slice as one_indicator
from workload import inputs as src
from workload.comparisons import sweeps, to_digits
from workload.domain import GOVERNORS, ORDER_CTES, ORDER_FACT, governor_table, order_fact
from workload.inputs import with_ctes
from workload.registry import query

OUTCOMES = ["PIB per capita", "Vínculos formais por mil habitantes"]


def on_fact(select, *more):
    return with_ctes(
        *ORDER_CTES, *more, select=f"SELECT * FROM (WITH fact AS ({ORDER_FACT}) {select})"
    )


@query(
    "indicator_slice",
    on_fact("""SELECT ano, sigla_uf, dimensao, valor FROM fact
      WHERE id_indicador = '3_idhm' AND dimensao = '' AND sigla_uf IN ('NATION_1', 'NATION_9')"""),
)
def indicator_slice(spark, d):
    rows = one_indicator(order_fact(spark, d), "3_idhm")
    return rows.where((F.col("dimensao") == "") & F.col("sigla_uf").isin("NATION_1", "NATION_9"))


NAMED = """(SELECT *, CASE id_indicador WHEN '1_pib_per_capita' THEN 'PIB per capita'
      WHEN '5b_emprego_formal' THEN 'Vínculos formais por mil habitantes' END AS indicador_nome,
    CASE id_indicador WHEN '1_pib_per_capita' THEN 'R$/habitante'
      WHEN '5b_emprego_formal' THEN 'vínculos/1.000 hab.' END AS unidade
  FROM fact WHERE id_indicador IN ('1_pib_per_capita', '5b_emprego_formal') AND dimensao = '')"""


@query("selected_indicators", on_fact(f"SELECT * FROM {NAMED}"))
def selected_indicators(spark, d):
    """The third name has sub-dimensions and is refused."""
    return compare.selected_indicators(order_fact(spark, d), indicator_dim(spark), [*OUTCOMES, "IDHM"])


SHARE = """(SELECT ano, sigla_uf, dimensao, valor / sum(valor) OVER (PARTITION BY ano, sigla_uf) * 100 AS valor
  FROM fact WHERE id_indicador = '4_despesa_funcao')"""


@query(
    "page_state_series",
    on_fact(f"""SELECT ano, round(valor, 8) AS valor, nome_uf AS serie FROM {SHARE}
        JOIN estado USING (sigla_uf)
        WHERE dimensao = '5-LOW' AND sigla_uf IN ('NATION_4', 'NATION_6')
      UNION ALL SELECT ano, round(avg(valor), 8), 'Média ' || regiao FROM {SHARE}
        JOIN estado USING (sigla_uf) WHERE dimensao = '5-LOW'
        AND regiao = (SELECT regiao FROM estado WHERE sigla_uf = 'NATION_4') GROUP BY ano, regiao
      UNION ALL SELECT ano, round(avg(valor), 8), 'Média Brasil' FROM {SHARE}
        WHERE dimensao = '5-LOW' GROUP BY ano"""),
)
def page_state_series(spark, d):
    """In the order of the chart."""
    return pages.chart_order(to_digits(low_spending(spark, d), 8, "valor"))


def low_spending(spark, d):
    return pages.state_series(
        order_fact(spark, d),
        src.states(spark, d),
        "4_despesa_funcao",
        "NATION_4",
        dimension="5-LOW",
        as_share=True,
        extras=["NATION_6"],
    )


@query(
    "page_state_table",
    on_fact("""SELECT ano, round(valor, 6) AS valor, nome_uf AS serie FROM fact JOIN estado USING (sigla_uf)
        WHERE id_indicador = '5b_emprego_formal' AND sigla_uf = 'NATION_4'
      UNION ALL SELECT ano, round(avg(valor), 6), 'Média ' || regiao FROM fact JOIN estado USING (sigla_uf)
        WHERE id_indicador = '5b_emprego_formal'
        AND regiao = (SELECT regiao FROM estado WHERE sigla_uf = 'NATION_4') GROUP BY ano, regiao
      UNION ALL SELECT ano, round(avg(valor), 6), 'Média Brasil' FROM fact
        WHERE id_indicador = '5b_emprego_formal' GROUP BY ano"""),
)
def page_state_table(spark, d):
    """In the order of the table, if any value is found."""
    fact, states = order_fact(spark, d), src.states(spark, d)
    chart_and_table = pages.state_report(pages.state_series(fact, states, "5b_emprego_formal", "NATION_4"))
    return to_digits(chart_and_table[1], 6, "valor")


TERMS = f"""SELECT sigla_uf, year(inicio_mandato)::INTEGER AS ano_inicio,
    year(fim_mandato)::INTEGER AS ano_fim,
    string_split_regex(trim(nome_candidato), '\\s+')[1] || ' (' || sigla_partido || ')' AS rotulo,
    ((row_number() OVER (PARTITION BY sigla_uf ORDER BY inicio_mandato, nome_candidato) - 1) % 2)::INTEGER AS faixa
  FROM ({GOVERNORS}) WHERE NOT requer_revisao_manual"""


@query(
    "page_state_terms",
    with_ctes(
        "elections",
        select=TERMS,
    ),
)
def page_state_terms(spark, d):
    return pages.state_terms(governor_table(spark, d), None)


@query("page_one_state_terms", with_ctes("elections", select=f"SELECT * FROM ({TERMS}) WHERE sigla_uf = 'NATION_6'"))
def page_one_state_terms(spark, d):
    return pages.state_terms(governor_table(spark, d), "NATION_6")


@query(
    "page_detail_options",
    on_fact("SELECT DISTINCT dimensao FROM fact WHERE id_indicador = '3_idhm' AND dimensao <> '' ORDER BY 1"),
)
def page_detail_options(spark, d):
    return pages.detail_options(order_fact(spark, d), "3_idhm")


@query(
    "page_other_states",
    on_fact("""SELECT DISTINCT sigla_uf FROM fact WHERE id_indicador = '5b_emprego_formal'
      AND sigla_uf <> 'NATION_4' ORDER BY 1"""),
)
def page_other_states(spark, d):
    return pages.other_states(order_fact(spark, d), "5b_emprego_formal", "NATION_4")


@query(
    "page_entity_options",
    with_ctes(
        "estado",
        select="""SELECT 1 AS grupo, nome_uf AS entidade FROM estado
          UNION SELECT 2, 'Região ' || regiao FROM estado UNION SELECT 3, 'Brasil (média)' """,
    ),
)
def page_entity_options(spark, d):
    return pages.entity_options(src.states(spark, d))


@query(
    "page_function_options",
    on_fact("SELECT DISTINCT dimensao FROM fact WHERE id_indicador = '4_despesa_funcao' ORDER BY 1"),
)
def page_function_options(spark, d):
    return pages.function_options(order_fact(spark, d))


def _grains(rows, *by):
    keys = ", ".join(by)
    return f"""(SELECT {keys}, valor, nome_uf AS entidade FROM {rows} LEFT JOIN estado USING (sigla_uf)
      UNION ALL SELECT {keys}, avg(valor), 'Região ' || regiao FROM {rows} JOIN estado USING (sigla_uf)
        GROUP BY {keys}, regiao
      UNION ALL SELECT {keys}, avg(valor), 'Brasil (média)' FROM {rows} GROUP BY {keys})"""


SPENT = _grains(SHARE, "ano", "dimensao")
FOUND = _grains(NAMED, "ano", "indicador_nome", "unidade")


def spent(spark, d, fact=None, **more):
    return pages.spending_series(fact or order_fact(spark, d), src.states(spark, d), as_share=True, **more)


def found(spark, d, fact=None, **more):
    return pages.outcome_series(fact or order_fact(spark, d), src.states(spark, d), indicator_dim(spark), OUTCOMES, **more)


@query(
    "page_spending_series",
    on_fact(f"""SELECT ano, dimensao, round(valor, 8) AS valor, entidade,
        entidade || ' — ' || dimensao AS serie, ano + 1 AS ano_exibido
      FROM {SPENT} WHERE dimensao IN ('2-HIGH', '3-MEDIUM') AND entidade IN ('Brasil (média)', 'Região ASIA', 'Estado 3')"""),
)
def page_spending_series(spark, d):
    chosen = ["Brasil (média)", "Região ASIA", "Estado 3"]
    series = spent(spark, d, functions=["2-HIGH", "3-MEDIUM"], entities=chosen, lag=1)
    return to_digits(series, 8, "valor")


@query(
    "page_outcome_series",
    on_fact(f"""SELECT ano, indicador_nome, unidade,
        round(CASE indicador_nome WHEN '{OUTCOMES[0]}' THEN valor / 1e6 ELSE valor END, 8) AS valor, entidade,
        entidade || ' — ' || indicador_nome AS serie FROM {FOUND}"""),
)
def page_outcome_series(spark, d):
    """The larger indicator in millions, so that eight digits are left of both."""
    large = F.col("indicador_nome") == OUTCOMES[0]
    series = found(spark, d).withColumn("valor", F.when(large, F.col("valor") / 1e6).otherwise(F.col("valor")))
    return to_digits(series, 8, "valor")


@query(
    "page_correlations",
    on_fact(f"""SELECT entidade, funcao, indicador_nome, n,
        CASE WHEN NOT isnan(r) THEN round_even(r, 3) END AS correlacao
      FROM (SELECT s.entidade, s.dimensao AS funcao, indicador_nome, count(*) AS n, corr(s.valor, f.valor) AS r
        FROM {SPENT} s JOIN {FOUND} f ON s.entidade = f.entidade AND s.ano + 1 = f.ano GROUP BY ALL)
      WHERE n >= 3"""),
)
def page_correlations(spark, d):
    fact = order_fact(spark, d)
    return pages.correlations(spent(spark, d, fact), found(spark, d, fact), lag=1)


def of_large(large, small):
    """SQL: one figure for the larger indicator, in millions, another for the smaller."""
    return f"CASE WHEN dimensao LIKE '%|{OUTCOMES[0]}' THEN {large} ELSE {small} END"


@query(
    "page_regressions",
    on_fact(
        f"""SELECT split_part(dimensao, '|', 1) AS funcao, split_part(dimensao, '|', 2) AS indicador_nome,
          * EXCLUDE (dimensao) FROM (
          WITH RECURSIVE panel AS (
            SELECT s.dimensao || '|' || indicador_nome AS dimensao, s.sigla_uf, s.ano, s.valor AS x, f.valor AS y
            FROM {SHARE} s JOIN {NAMED} f ON s.sigla_uf = f.sigla_uf AND s.ano = f.ano),
          {sweeps(of_large("round(b / 1e6, 6)", "round_even(b, 5)"), of_large("round(se / 1e6, 6)", "round(se, 4)"))})"""
    ),
)
def page_regressions(spark, d):
    """Every function against both indicators; effects on the larger one in millions, so that digits fit its size."""
    out = pages.regressions(order_fact(spark, d), indicator_dim(spark), OUTCOMES, as_share=True)
    large = F.col("indicador_nome") == OUTCOMES[0]
    effect, error = F.col("efeito"), F.col("erro_padrao")
    return out.withColumns(
        {
            "efeito": F.when(large, F.round(effect / 1e6, 6)).otherwise(effect),
            "erro_padrao": F.when(large, F.round(error / 1e6, 6)).otherwise(F.round(error, 4)),
        }
    )
