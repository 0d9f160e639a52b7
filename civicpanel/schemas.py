"""Explicit schemas as DDL text. Nothing is inferred: codes stay strings.

Fixed values: column and file names are those of the stored tables.
"""

# Raw inputs.
DEATHS = (
    "ano INT, sigla_uf STRING, tipo_obito STRING, idade DOUBLE, "
    "data_nascimento DATE, data_obito DATE, causa_basica STRING"
)
BIRTHS = "ano INT, sigla_uf STRING"
EMPLOYMENT_LINKS = "ano INT, sigla_uf STRING, vinculo_ativo_3112 STRING"
DEFORESTATION = "ano INT, id_municipio STRING, bioma STRING, desmatado DOUBLE"
MUNICIPALITIES = "id_municipio STRING, sigla_uf STRING"
SANITATION = (
    "ano INT, sigla_uf STRING, populacao_urbana BIGINT, "
    "indice_atendimento_total_agua DOUBLE, indice_coleta_esgoto DOUBLE"
)
SPENDING = (
    "ano INT, sigla_uf STRING, id_conta_bd STRING, conta_bd STRING, "
    "estagio_bd STRING, valor DOUBLE"
)
SCHOOL_INDEX = (
    "ano INT, sigla_uf STRING, rede STRING, ensino STRING, anos_escolares STRING, "
    "ideb DOUBLE, taxa_aprovacao DOUBLE"
)
DEVELOPMENT_INDEX = (
    "ano INT, sigla_uf STRING, idhm DOUBLE, idhm_e DOUBLE, idhm_l DOUBLE, idhm_r DOUBLE"
)
ELECTION_RESULTS = (
    "ano INT, sigla_uf STRING, turno INT, cargo STRING, resultado STRING, "
    "nome_candidato STRING, sigla_partido STRING"
)

# Nested statistical responses: a file or column holds an array of these blocks.
SERIES_BLOCK = (
    "id STRING, resultados ARRAY<STRUCT<"
    "classificacoes: ARRAY<STRUCT<id: STRING, categoria: MAP<STRING, STRING>>>, "
    "series: ARRAY<STRUCT<localidade: STRUCT<id: STRING, nome: STRING>, "
    "serie: MAP<STRING, STRING>>>>>"
)
TABLE_METADATA = (
    "id STRING, nome STRING, pesquisa STRING, "
    "variaveis ARRAY<STRUCT<id: STRING, nome: STRING, unidade: STRING>>, "
    "classificacoes ARRAY<STRUCT<id: STRING, nome: STRING, "
    "categorias: ARRAY<STRUCT<id: STRING, nome: STRING>>>>"
)

# Per-indicator tables, by the name of the stored file.
INDICATOR_TABLES = {
    "pib_per_capita_uf": (
        "ano INT, cod_uf STRING, uf STRING, pib_mil_reais DOUBLE, populacao DOUBLE, "
        "pib_per_capita_reais DOUBLE"
    ),
    "gini_uf": "ano INT, cod_uf STRING, uf STRING, indice_gini DOUBLE",
    "idhm_uf": (
        "ano INT, sigla_uf STRING, idhm DOUBLE, idhm_educacao DOUBLE, "
        "idhm_longevidade DOUBLE, idhm_renda DOUBLE"
    ),
    "despesas_funcao_uf": (
        "ano INT, uf STRING, funcao STRING, estagio STRING, valor_reais DOUBLE"
    ),
    "taxa_desocupacao_uf": (
        "ano INT, cod_uf STRING, uf STRING, taxa_desocupacao_media_anual DOUBLE, "
        "trimestres_disponiveis BIGINT"
    ),
    "emprego_formal_uf": (
        "ano INT, sigla_uf STRING, vinculos_ativos BIGINT, populacao DOUBLE, "
        "vinculos_por_mil_habitantes DOUBLE"
    ),
    "desmatamento_uf": (
        "ano INT, sigla_uf STRING, area_desmatada_incremento_km2 DOUBLE"
    ),
    "mortalidade_infantil_uf_oficial": (
        "ano INT, cod_uf STRING, uf STRING, taxa_mortalidade_infantil_oficial DOUBLE"
    ),
    "ideb_uf": (
        "ano INT, sigla_uf STRING, ensino STRING, anos_escolares STRING, ideb DOUBLE, "
        "taxa_aprovacao DOUBLE"
    ),
    "taxa_homicidios_uf": (
        "ano INT, sigla_uf STRING, obitos_homicidio BIGINT, populacao DOUBLE, "
        "taxa_homicidios_100mil DOUBLE"
    ),
    "saneamento_uf": (
        "ano INT, sigla_uf STRING, taxa_atendimento_agua DOUBLE, taxa_atendimento_esgoto DOUBLE"
    ),
    "governadores_uf": (
        "ano_eleicao INT, sigla_uf STRING, nome_candidato STRING, sigla_partido STRING, "
        "inicio_mandato DATE, fim_mandato DATE, requer_revisao_manual BOOLEAN"
    ),
}

# Star schema.
STATE_DIM = "cod_uf STRING, sigla_uf STRING, nome_uf STRING, regiao STRING"
INDICATOR_DIM = (
    "id_indicador STRING, nome STRING, unidade STRING, fonte STRING, periodicidade STRING"
)
TERM_DIM = INDICATOR_TABLES["governadores_uf"]
FACT = (
    "ano INT, sigla_uf STRING, id_indicador STRING, dimensao STRING, valor DOUBLE"
)
