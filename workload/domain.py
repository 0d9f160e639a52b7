"""The published sub-indicators and the fact table, on derived raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.operators import compare, longform, tenure
from civicpanel.plans import indicators as ind
from civicpanel.plans import star
from civicpanel.sources import frames, nested
from civicpanel.sources.scratch import stored
from workload import inputs as src
from workload.inputs import with_ctes
from workload.registry import query

PER_CAPITA = """SELECT ano, cod_uf, uf, pib_mil_reais, populacao,
    pib_mil_reais * 1000 / populacao AS pib_per_capita_reais
  FROM gdp JOIN population USING (ano, cod_uf, uf)"""


def per_capita_table(spark, d, rows=None, population=None):
    """The tables take rolled-up orders in place of the orders themselves."""
    return ind.gdp_per_capita(src.gdp(rows or src.placed(spark, d)), population or src.population(src.customers(spark, d)))


@query("indicator_gdp_per_capita", with_ctes("gdp", "population", select=PER_CAPITA))
def indicator_gdp_per_capita(spark, d):
    return per_capita_table(spark, d)


SPENDING = """SELECT ano, sigla_uf AS uf, conta_bd AS funcao, estagio_bd AS estagio, sum(valor) AS valor_reais
  FROM spending WHERE estagio_bd = 'Despesas Liquidadas' AND id_conta_bd LIKE '3.%.000'
  AND id_conta_bd <> '3.00.000' AND ano BETWEEN 1996 AND 2000{} GROUP BY ALL"""


def spending_table(spark, d, functions=None, rows=None):
    rows = rows or src.placed(spark, d, 1996, 2000)
    return ind.spending_by_function(src.spending(rows), 1996, 2000, functions=functions)


@query("indicator_spending", with_ctes("spending", select=SPENDING.format("")))
def indicator_spending(spark, d):
    return spending_table(spark, d)


@query(
    "indicator_spending_chosen",
    with_ctes("spending", select=SPENDING.format(" AND conta_bd IN ('2-HIGH', '5-LOW')")),
)
def indicator_spending_chosen(spark, d):
    return spending_table(spark, d, ["2-HIGH ", " 5-LOW"])


EMPLOYMENT = """SELECT ano, sigla_uf, vinculos_ativos, populacao,
    vinculos_ativos / populacao * 1000 AS vinculos_por_mil_habitantes
  FROM (SELECT ano, sigla_uf, count(*) AS vinculos_ativos FROM placed
        WHERE o_orderstatus = 'F' AND ano BETWEEN 1996 AND 2000 GROUP BY ALL)
  LEFT JOIN per_head USING (ano, sigla_uf)"""


def employment_table(spark, d, rows=None, per_head=None):
    links = src.links(rows or src.placed(spark, d, 1996, 2000))
    return ind.formal_employment(links, per_head or src.per_head(spark, d, 1996, 2000), 1996, 2000, count="pedidos")


@query("indicator_formal_employment", with_ctes("per_head", select=EMPLOYMENT))
def indicator_formal_employment(spark, d):
    return employment_table(spark, d)


DEFORESTATION = """SELECT ano, sigla_uf, sum(greatest(passo, 0)) AS area_desmatada_incremento_km2 FROM (
    SELECT ano, id_municipio, desmatado - lag(desmatado) OVER w AS passo, lag(ano) OVER w AS antes
    FROM deforestation WHERE ano BETWEEN 1995 AND 2000
    WINDOW w AS (PARTITION BY id_municipio, bioma ORDER BY ano))
  JOIN municipalities USING (id_municipio)
  WHERE passo IS NOT NULL AND antes = ano - 1 AND ano >= 1996 GROUP BY ALL"""


def deforestation_table(spark, d):
    return ind.deforestation(src.deforestation(spark, d), src.municipalities(spark, d), 1996, 2000)


@query("indicator_deforestation", with_ctes("deforestation", "municipalities", select=DEFORESTATION))
def indicator_deforestation(spark, d):
    return deforestation_table(spark, d)


@query(
    "indicator_infant_mortality_raw",
    with_ctes(
        "deaths",
        select="""SELECT n.ano, n.sigla_uf, coalesce(obitos, 0) AS obitos_infantis, nascidos_vivos,
            coalesce(obitos, 0)::DOUBLE / nascidos_vivos * 1000 AS taxa_mortalidade_infantil
          FROM (SELECT ano, sigla_uf, count(*) AS nascidos_vivos FROM placed
                WHERE ano BETWEEN 1996 AND 2000 GROUP BY ALL) n
          LEFT JOIN (SELECT ano, sigla_uf, count(*) AS obitos FROM deaths
                WHERE tipo_obito = 'nao-fetal' AND ano BETWEEN 1996 AND 2000
                AND (idade = 0 OR (idade IS NULL AND data_nascimento IS NOT NULL AND data_obito IS NOT NULL
                     AND datediff('day', data_nascimento, data_obito) < 365)) GROUP BY ALL) o
          ON n.ano = o.ano AND n.sigla_uf = o.sigla_uf""",
    ),
)
def indicator_infant_mortality_raw(spark, d):
    years = (1996, 2000)
    return ind.infant_mortality_raw(src.infant_deaths(spark, d, *years), src.births(spark, d, *years), *years)


HOMICIDES = """SELECT ano, sigla_uf, obitos_homicidio, populacao,
    obitos_homicidio / populacao * 100000 AS taxa_homicidios_100mil
  FROM (SELECT ano, sigla_uf, count(*) AS obitos_homicidio FROM deaths
        WHERE tipo_obito = 'nao-fetal' AND ano BETWEEN 1996 AND 2000
        AND substr(causa_basica, 1, 3) BETWEEN 'X85' AND 'Y09' GROUP BY ALL)
  LEFT JOIN per_head USING (ano, sigla_uf)"""


def homicide_table(spark, d):
    return ind.homicide_rate(src.deaths(spark, d, 1996, 2000), src.per_head(spark, d, 1996, 2000), 1996, 2000)


@query("indicator_homicide_rate", with_ctes("deaths", "per_head", select=HOMICIDES))
def indicator_homicide_rate(spark, d):
    return homicide_table(spark, d)


SANITATION = """SELECT ano, sigla_uf,
    sum(indice_atendimento_total_agua * populacao_urbana) / sum(populacao_urbana) AS taxa_atendimento_agua,
    sum(indice_coleta_esgoto * populacao_urbana) / sum(populacao_urbana) AS taxa_atendimento_esgoto
  FROM sanitation WHERE ano BETWEEN 1996 AND 2000 AND populacao_urbana > 0 GROUP BY ALL"""


def sanitation_table(spark, d):
    return ind.sanitation(src.sanitation(spark, d, 1996, 2000), 1996, 2000)


@query("indicator_sanitation", with_ctes("sanitation", select=SANITATION))
def indicator_sanitation(spark, d):
    return sanitation_table(spark, d)


SCHOOLS = """SELECT ano, sigla_uf, ensino, anos_escolares, ideb, taxa_aprovacao FROM schools
  WHERE rede = 'estadual' AND ano BETWEEN 1996 AND 2000 AND ideb IS NOT NULL"""


def school_table(spark, d, rows=None):
    return ind.school_index(src.schools(rows or src.placed(spark, d, 1996, 2000)), 1996, 2000)


@query("indicator_school_index", with_ctes("schools", select=SCHOOLS))
def indicator_school_index(spark, d):
    return school_table(spark, d)


DEVELOPMENT = """SELECT ano, sigla_uf, idhm, idhm_e AS idhm_educacao, idhm_l AS idhm_longevidade,
    idhm_r AS idhm_renda FROM development WHERE idhm IS NOT NULL"""


def development_table(spark, d, rows=None):
    return ind.development_index(src.development(rows or src.placed(spark, d)))


@query("indicator_development_index", with_ctes("development", select=DEVELOPMENT))
def indicator_development_index(spark, d):
    return development_table(spark, d)


GOVERNORS = """SELECT ano_eleicao, sigla_uf, nome_candidato, sigla_partido,
    CASE WHEN NOT f THEN make_date(ano_eleicao + 1, 1, 1) END AS inicio_mandato,
    CASE WHEN NOT f THEN make_date(ano_eleicao + 4, 12, 31) END AS fim_mandato,
    f AS requer_revisao_manual
  FROM (SELECT *, count(*) OVER (PARTITION BY ano_eleicao, sigla_uf) > 1 AS f FROM (
    SELECT DISTINCT ano AS ano_eleicao, sigla_uf, nome_candidato, sigla_partido FROM elections
    WHERE cargo = 'governador' AND resultado = 'eleito' AND ano BETWEEN 1995 AND 2001))"""


def governor_table(spark, d):
    return ind.governors(src.elections(spark, d), 1995, 2001)


@query("indicator_governors", with_ctes("elections", select=GOVERNORS))
def indicator_governors(spark, d):
    return governor_table(spark, d)


@query(
    "unlisted_double_terms",
    with_ctes(
        "elections",
        select=f"SELECT DISTINCT ano_eleicao, sigla_uf FROM ({GOVERNORS}) WHERE requer_revisao_manual",
    ),
)
def unlisted_double_terms(spark, d):
    return ind.unlisted_double_terms(governor_table(spark, d))


# --- nested responses -----------------------------------------------------------


def quarter_blocks(spark, d, rows=None):
    return nested.parse_series_blocks(src.quarter_documents(rows or src.placed(spark, d)), "json")


def year_blocks(spark, d, rows=None):
    return nested.parse_series_blocks(src.year_documents(rows or src.placed(spark, d)), "json")


@query(
    "nested_series_flatten",
    with_ctes(
        "quarters",
        select="""SELECT periodo::INTEGER AS ano, cod_uf, uf, valor AS indice_gini FROM quarters
          WHERE pedidos >= 3""",
    ),
)
def nested_series_flatten(spark, d):
    return ind.gini(quarter_blocks(spark, d))


UNEMPLOYMENT = """SELECT ano, cod_uf, uf, avg(valor) AS taxa_desocupacao_media_anual,
    count(*) AS trimestres_disponiveis FROM quarters WHERE pedidos >= 3 GROUP BY ALL"""


def unemployment_table(spark, d, rows=None):
    return ind.unemployment(quarter_blocks(spark, d, rows))


@query("indicator_unemployment", with_ctes("quarters", select=UNEMPLOYMENT))
def indicator_unemployment(spark, d):
    return unemployment_table(spark, d)


OFFICIAL = """SELECT ano, cod_uf, nome_uf AS uf, sum(valor) AS taxa_mortalidade_infantil_oficial
  FROM placed GROUP BY ALL HAVING count(*) >= 10"""


def official_table(spark, d, rows=None):
    return ind.infant_mortality_official(year_blocks(spark, d, rows))


@query("indicator_infant_mortality_official", with_ctes("placed", select=OFFICIAL))
def indicator_infant_mortality_official(spark, d):
    return official_table(spark, d)


@query(
    "nested_metadata_variables",
    """SELECT p_partkey::VARCHAR AS tabela, id, nome, unidade, lower(nome) LIKE '%per capita%' AS populacional
       FROM (SELECT p_partkey, 'a' AS id, p_name AS nome, p_type AS unidade FROM part
             UNION ALL SELECT p_partkey, 'b', p_brand || ' Per Capita', NULL FROM part)""",
)
def nested_metadata_variables(spark, d):
    """One metadata text per part, with two variables; the second has no unit."""
    name, brand = F.col("p_name"), F.concat("p_brand", F.lit(" Per Capita"))
    variables = F.array(
        F.struct(F.lit("a").alias("id"), name.alias("nome"), F.col("p_type").alias("unidade")),
        F.struct(F.lit("b").alias("id"), brand.alias("nome"), F.lit(None).cast("string").alias("unidade")),
    )
    json = F.to_json(F.struct(F.lit("t").alias("id"), variables.alias("variaveis")))
    texts = src.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("tabela"), json.alias("json"))
    return nested.metadata_variables(nested.parse_metadata(texts, "json", "tabela"), "tabela")


@query(
    "nested_metadata_categories",
    """SELECT r_name AS id_classificacao, r_regionkey::VARCHAR AS classificacao,
         n_nationkey::VARCHAR AS id_categoria, n_name AS categoria
       FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND r_name <> 'ASIA'""",
)
def nested_metadata_categories(spark, d):
    """Regions as classifications, their nations as categories; one region has none."""
    nation, region = src.table(spark, d, "nation"), src.table(spark, d, "region")
    joined = region.join(
        nation, (nation.n_regionkey == region.r_regionkey) & (region.r_name != "ASIA"), "left"
    )
    category = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("nome"))
    per_region = joined.groupBy("r_name", "r_regionkey").agg(
        F.collect_list(F.when(F.col("n_name").isNotNull(), category)).alias("categorias")
    )
    classes = F.struct(
        F.col("r_name").alias("id"), F.col("r_regionkey").cast("string").alias("nome"), "categorias"
    )
    json = F.to_json(F.struct(F.lit("t").alias("id"), F.array(classes).alias("classificacoes")))
    return nested.metadata_categories(nested.parse_metadata(per_region.select(json.alias("json")), "json"))


# --- fact table -----------------------------------------------------------------

SCHOOL_PART = f"""SELECT ano, sigla_uf, '8_ideb' AS id_indicador, ensino || '_' || anos_escolares AS dimensao,
    ideb AS valor FROM ({SCHOOLS})"""


def _melt(table, id_indicador, **dimensions):
    return "\nUNION ALL ".join(
        f"SELECT ano, sigla_uf, '{id_indicador}' AS id_indicador, '{dimension}' AS dimensao, {column} AS valor "
        f"FROM ({table}) WHERE {column} IS NOT NULL"
        for column, dimension in dimensions.items()
    )


def _coded(table):
    return f"SELECT t.*, e.sigla_uf FROM ({table}) t LEFT JOIN estado e USING (cod_uf)"


# Indicators that need orders only, the base of the comparison reports.
ORDER_FACT = "\nUNION ALL ".join(
    [
        _melt(_coded(PER_CAPITA), "1_pib_per_capita", pib_per_capita_reais=""),
        _melt(
            DEVELOPMENT, "3_idhm", idhm="", idhm_educacao="educacao", idhm_longevidade="longevidade",
            idhm_renda="renda",
        ),
        f"SELECT ano, uf, '4_despesa_funcao', funcao, valor_reais FROM ({SPENDING.format('')})",
        _melt(EMPLOYMENT, "5b_emprego_formal", vinculos_por_mil_habitantes=""),
    ]
)
WHOLE_FACT = "\nUNION ALL ".join(
    [
        ORDER_FACT,
        _melt(_coded(UNEMPLOYMENT), "5a_taxa_desocupacao", taxa_desocupacao_media_anual=""),
        _melt(DEFORESTATION, "6_desmatamento", area_desmatada_incremento_km2=""),
        _melt(_coded(OFFICIAL), "7_mortalidade_infantil", taxa_mortalidade_infantil_oficial=""),
        SCHOOL_PART,
        _melt(HOMICIDES, "9_taxa_homicidios", taxa_homicidios_100mil=""),
        _melt(SANITATION, "10a_saneamento_agua", taxa_atendimento_agua=""),
        _melt(SANITATION, "10b_saneamento_esgoto", taxa_atendimento_esgoto=""),
    ]
)
ORDER_CTES = ("gdp", "population", "development", "spending", "per_head")
WHOLE_CTES = (*ORDER_CTES, "quarters", "deforestation", "municipalities", "schools", "deaths", "sanitation")


def order_tables(spark, d, rows, population):
    per_head = ind.state_population(population, src.states(spark, d))
    return {
        "pib_per_capita_uf": per_capita_table(spark, d, rows, population),
        "idhm_uf": development_table(spark, d, rows),
        "despesas_funcao_uf": spending_table(spark, d, rows=rows),
        "emprego_formal_uf": employment_table(spark, d, rows, per_head),
    }


def order_fact(spark, d):
    """The fact of the indicators that need orders only, stored.

    Two passes over the orders: one roll-up, and the bitmaps of their customers.
    """
    tables = order_tables(spark, d, src.rolled_up(spark, d), src.population(src.customers(spark, d)))
    return stored(star.consolidate(tables, src.states(spark, d)), "order_fact")


def whole_tables(spark, d):
    """All tables from one roll-up of the orders, one of the lines and the bitmaps of customers."""
    rows, population = src.rolled_up(spark, d), src.population(src.customers(spark, d))
    per_head = ind.state_population(population, src.states(spark, d))
    deaths, sanitation = src.rolled_up_lines(spark, d, 1996, 2000)
    return {
        **order_tables(spark, d, rows, population),
        "taxa_desocupacao_uf": unemployment_table(spark, d, rows),
        "desmatamento_uf": deforestation_table(spark, d),
        "mortalidade_infantil_uf_oficial": official_table(spark, d, rows),
        "ideb_uf": school_table(spark, d, rows),
        "taxa_homicidios_uf": ind.homicide_rate(deaths, per_head, 1996, 2000, count="linhas"),
        "saneamento_uf": ind.sanitation(sanitation, 1996, 2000),
    }


def whole_fact(spark, d):
    return star.consolidate(whole_tables(spark, d), src.states(spark, d))


@query("consolidated_fact", with_ctes(*WHOLE_CTES, select=WHOLE_FACT))
def consolidated_fact(spark, d):
    return whole_fact(spark, d)


@query(
    "dry_run_by_indicator",
    with_ctes(*WHOLE_CTES, select=f"SELECT id_indicador, count(*) AS linhas FROM ({WHOLE_FACT}) GROUP BY 1"),
)
def dry_run_by_indicator(spark, d):
    return star.dry_run_by_indicator(whole_fact(spark, d))


@query(
    "dry_run_tables",
    with_ctes(
        *ORDER_CTES,
        "elections",
        select=f"""SELECT 'fato_indicador' AS tabela, count(*) AS linhas FROM ({ORDER_FACT})
          UNION ALL SELECT 'dim_indicador', {len(fv.INDICATORS)}
          UNION ALL SELECT 'dim_estado', count(*) FROM estado
          UNION ALL SELECT 'dim_governador', count(*) FROM ({GOVERNORS})""",
    ),
)
def dry_run_tables(spark, d):
    whole = star.Consolidation(
        order_fact(spark, d), src.states(spark, d), frames.indicator_dim(spark), governor_table(spark, d), []
    )
    return whole.counts()


@query(
    "school_stages",
    with_ctes("schools", select=f"SELECT DISTINCT ensino, anos_escolares FROM ({SCHOOLS})"),
)
def school_stages(spark, d):
    return compare.distinct_combinations(school_table(spark, d), "ensino", "anos_escolares")


@query(
    "term_of_fact",
    with_ctes(
        *ORDER_CTES,
        "elections",
        select=f"""SELECT f.*, nome_candidato FROM ({ORDER_FACT}) f
          LEFT JOIN (SELECT * FROM ({GOVERNORS}) WHERE NOT requer_revisao_manual AND ano_eleicao % 4 = 0) t
          ON f.sigla_uf = t.sigla_uf AND f.ano BETWEEN year(inicio_mandato) AND year(fim_mandato)""",
    ),
)
def term_of_fact(spark, d):
    """Elections four years apart, so that a fact year has one term at most."""
    terms = governor_table(spark, d).where("ano_eleicao % 4 = 0")
    return tenure.assign_term(order_fact(spark, d), terms, ["nome_candidato"]).select(
        *longform.LONG_COLUMNS, "nome_candidato"
    )


@query(
    "overlapping_terms",
    with_ctes(
        "elections",
        select=f"""SELECT sigla_uf, ano::INTEGER AS ano, count(*) AS count FROM ({GOVERNORS}) t,
            range(1995, 2010) r(ano) WHERE ano BETWEEN year(inicio_mandato) AND year(fim_mandato)
          GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
)
def overlapping_terms(spark, d):
    return tenure.overlapping_years(governor_table(spark, d))


CATALOGUE = ", ".join(str(row) for row in fv.INDICATORS)


@query(
    "catalogue_of_fact",
    with_ctes(
        *ORDER_CTES,
        select=f"""SELECT c.*, linhas FROM (VALUES {CATALOGUE}) c(id_indicador, nome, unidade, fonte, periodicidade)
          LEFT JOIN (SELECT id_indicador, count(*) AS linhas FROM ({ORDER_FACT}) GROUP BY 1) USING (id_indicador)""",
    ),
)
def catalogue_of_fact(spark, d):
    """Rows per catalogued indicator, absent ones with NULL."""
    counts = star.dry_run_by_indicator(order_fact(spark, d))
    return frames.indicator_dim(spark).join(counts, "id_indicador", "left")
