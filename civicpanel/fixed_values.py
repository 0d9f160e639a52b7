"""Codes, labels and catalogue entries that results must carry as they are."""

# --- fixed values: state code -> (abbreviation, name, region) -----------------
STATES = {
    "11": ("RO", "Rondônia", "Norte"),
    "12": ("AC", "Acre", "Norte"),
    "13": ("AM", "Amazonas", "Norte"),
    "14": ("RR", "Roraima", "Norte"),
    "15": ("PA", "Pará", "Norte"),
    "16": ("AP", "Amapá", "Norte"),
    "17": ("TO", "Tocantins", "Norte"),
    "21": ("MA", "Maranhão", "Nordeste"),
    "22": ("PI", "Piauí", "Nordeste"),
    "23": ("CE", "Ceará", "Nordeste"),
    "24": ("RN", "Rio Grande do Norte", "Nordeste"),
    "25": ("PB", "Paraíba", "Nordeste"),
    "26": ("PE", "Pernambuco", "Nordeste"),
    "27": ("AL", "Alagoas", "Nordeste"),
    "28": ("SE", "Sergipe", "Nordeste"),
    "29": ("BA", "Bahia", "Nordeste"),
    "31": ("MG", "Minas Gerais", "Sudeste"),
    "32": ("ES", "Espírito Santo", "Sudeste"),
    "33": ("RJ", "Rio de Janeiro", "Sudeste"),
    "35": ("SP", "São Paulo", "Sudeste"),
    "41": ("PR", "Paraná", "Sul"),
    "42": ("SC", "Santa Catarina", "Sul"),
    "43": ("RS", "Rio Grande do Sul", "Sul"),
    "50": ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    "51": ("MT", "Mato Grosso", "Centro-Oeste"),
    "52": ("GO", "Goiás", "Centro-Oeste"),
    "53": ("DF", "Distrito Federal", "Centro-Oeste"),
}

# --- fixed values: indicator catalogue (id, name, unit, source, period) --------
INDICATORS = [
    ("1_pib_per_capita", "PIB per capita", "R$/habitante",
     "IBGE/SIDRA (tabelas 5938 + 6579)", "anual"),
    ("2_gini", "Índice de Gini", "índice (0-1)",
     "IBGE/SIDRA (tabela 7435)", "anual"),
    ("3_idhm", "IDHM", "índice (0-1)",
     "Base dos Dados (mundo_onu_adh)", "decenal (1991/2000/2010)"),
    ("4_despesa_funcao", "Despesa por função", "R$ (liquidado)",
     "Base dos Dados (br_me_siconfi)", "anual"),
    ("5a_taxa_desocupacao", "Taxa de desocupação", "%",
     "IBGE/SIDRA (tabela 6396, média dos 4 trimestres)", "anual"),
    ("5b_emprego_formal", "Vínculos formais por mil habitantes", "vínculos/1.000 hab.",
     "Base dos Dados (br_me_rais)", "anual"),
    ("6_desmatamento", "Área desmatada (incremento anual)", "km²",
     "Base dos Dados (br_inpe_prodes)", "anual"),
    ("7_mortalidade_infantil", "Taxa de mortalidade infantil", "óbitos/1.000 nascidos vivos",
     "IBGE/SIDRA (tabela 7362, série oficial corrigida)", "anual (usar só até 2023)"),
    ("8_ideb", "IDEB (rede estadual)", "índice (0-10)",
     "Base dos Dados (br_inep_ideb)", "bienal"),
    ("9_taxa_homicidios", "Taxa de homicídios", "óbitos/100.000 hab.",
     "Base dos Dados (br_ms_sim)", "anual"),
    ("10a_saneamento_agua", "Atendimento de água", "%",
     "Base dos Dados (br_mdr_snis)", "anual"),
    ("10b_saneamento_esgoto", "Atendimento de esgoto", "%",
     "Base dos Dados (br_mdr_snis)", "anual"),
]

# --- fixed values: last usable year of a projected series ----------------------
VALID_UNTIL = {"7_mortalidade_infantil": 2023}

# --- fixed values: missing-value marks of the statistical JSON -----------------
MISSING_MARKS = ("-", "...", "X", "..")

# --- fixed values: classification that carries the reference year --------------
YEAR_CLASSIFICATION = "1933"

# --- fixed values: reference year -> category id of that classification --------
YEAR_CATEGORIES = {
    2000: "116338", 2001: "116336", 2002: "116335", 2003: "116334", 2004: "116332",
    2005: "116331", 2006: "116330", 2007: "116329", 2008: "116327", 2009: "119270",
    2010: "4336", 2011: "12037", 2012: "13242", 2013: "49029", 2014: "49030",
    2015: "49031", 2016: "49032", 2017: "49033", 2018: "49034", 2019: "49035",
    2020: "49036", 2021: "49037", 2022: "49038", 2023: "49039", 2024: "49040",
    2025: "49041", 2026: "49042", 2027: "49043", 2028: "49044", 2029: "49045",
    2030: "49046", 2031: "49047", 2032: "49048", 2033: "49049", 2034: "49050",
    2035: "49051", 2036: "49052", 2037: "49053", 2038: "49054", 2039: "49055",
    2040: "49056", 2041: "49057", 2042: "49058", 2043: "49059", 2044: "49060",
    2045: "49061", 2046: "49062", 2047: "49063", 2048: "49064", 2049: "49065",
    2050: "49066", 2051: "49067", 2052: "49068", 2053: "49069", 2054: "49070",
    2055: "49071", 2056: "49072", 2057: "49073", 2058: "49074", 2059: "49075",
    2060: "49076",
}

# --- fixed values: source filters ----------------------------------------------
LIVE_BIRTH_DEATH = "nao-fetal"
HOMICIDE_CAUSES = ("X85", "Y09")
ACTIVE_LINK = "1"
STATE_NETWORK = "estadual"
SETTLED_SPENDING = "Despesas Liquidadas"
FUNCTION_TOTALS = "3.%.000"
ALL_FUNCTIONS = "3.00.000"
OFFICE, ELECTED = "governador", "eleito"

# --- fixed values: (election, state) pairs known to have two elected people ----
KNOWN_DOUBLE_TERMS = [(2014, "AM"), (2014, "TO")]

# --- fixed values: indicators whose rows carry a sub-dimension -----------------
WITH_DIMENSIONS = ("4_despesa_funcao", "3_idhm", "8_ideb")
SPENDING_ID = "4_despesa_funcao"

# --- fixed values: words that mark population variables in table metadata ------
POPULATION_WORDS = ("per capita", "população", "populacao")

# --- fixed values: labels ------------------------------------------------------
REGION_PREFIX = "Região "
COUNTRY_ENTITY = "Brasil (média)"
MEAN_PREFIX = "Média "
COUNTRY_SERIES = "Média Brasil"
SERIES_SEPARATOR = " — "

# --- fixed values: regression verdicts -----------------------------------------
VERDICT_FEW = "Dados insuficientes para rodar a regressão com confiança"
VERDICT_DOWN = (
    "Estatisticamente significativo (p<0,05): "
    "aumento no gasto associado a reduz o indicador"
)
VERDICT_UP = (
    "Estatisticamente significativo (p<0,05): "
    "aumento no gasto associado a aumenta o indicador"
)
VERDICT_NONE = "Não significativo — não há evidência estatística suficiente"
VERDICT_FAILED = "Não foi possível estimar"
