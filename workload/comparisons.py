"""Shares, larger groups, terms of office, association, regression and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicpanel.operators import association, compare, filters, lookups, quality, tenure
from civicpanel.operators.long_panels import fixed_effects_long
from civicpanel.operators.panel_regression import fixed_effects as fixed_effects_by
from civicpanel.sources.frames import literal_frame
from workload import inputs as src
from workload.inputs import with_ctes
from workload.registry import query


def shares(spark, d):
    return compare.share_of_total(src.purchases(spark, d), ["ano", "sigla_uf"])


def to_digits(df, digits, *columns):
    """Cut rounding noise of sums whose order is not fixed."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


SHARES = """shares AS (SELECT ano, sigla_uf, dimensao,
  valor / sum(valor) OVER (PARTITION BY ano, sigla_uf) * 100 AS valor FROM purchases)"""


def on_shares(select):
    return with_ctes("purchases", select=f"SELECT * FROM (WITH {SHARES} {select})")


@query("share_of_total", on_shares("SELECT * FROM shares"))
def share_of_total(spark, d):
    return shares(spark, d)


@query(
    "region_mean",
    on_shares("""SELECT ano, dimensao, regiao, round(avg(valor), 8) AS valor
                 FROM shares JOIN estado USING (sigla_uf) GROUP BY ALL"""),
)
def region_mean(spark, d):
    placed = shares(spark, d).join(src.states(spark, d), "sigla_uf", "left")
    return to_digits(compare.group_mean(placed, ["ano", "dimensao", "regiao"]), 8, "valor")


@query(
    "country_mean",
    on_shares("SELECT ano, dimensao, round(avg(valor), 8) AS valor FROM shares GROUP BY ALL"),
)
def country_mean(spark, d):
    return to_digits(compare.group_mean(shares(spark, d), ["ano", "dimensao"]), 8, "valor")


@query(
    "region_weighted_mean",
    with_ctes(
        "purchases",
        select="""SELECT ano, regiao, sum(valor * length(nome_uf)) / sum(length(nome_uf)) AS valor
          FROM purchases JOIN estado USING (sigla_uf) GROUP BY ALL""",
    ),
)
def region_weighted_mean(spark, d):
    weighted = src.states(spark, d).withColumn("peso", F.length("nome_uf"))
    placed = src.purchases(spark, d).join(weighted, "sigla_uf")
    return compare.group_mean(placed, ["ano", "regiao"], weight="peso")


@query(
    "expand_entities",
    on_shares("""SELECT ano, dimensao, round(valor, 8) AS valor, nome_uf AS entidade
        FROM shares JOIN estado USING (sigla_uf)
      UNION ALL SELECT ano, dimensao, round(avg(valor), 8), 'Região ' || regiao
        FROM shares JOIN estado USING (sigla_uf) GROUP BY ano, dimensao, regiao
      UNION ALL SELECT ano, dimensao, round(avg(valor), 8), 'Brasil (média)'
        FROM shares GROUP BY ano, dimensao"""),
)
def expand_entities(spark, d):
    return to_digits(compare.expand_entities(shares(spark, d), src.states(spark, d)), 8, "valor")


@query(
    "focus_series",
    on_shares("""SELECT ano, round(valor, 8) AS valor, nome_uf AS serie
        FROM shares JOIN estado USING (sigla_uf)
        WHERE dimensao = '2-HIGH' AND sigla_uf IN ('NATION_3', 'NATION_7', 'NATION_20')
      UNION ALL SELECT ano, round(avg(valor), 8), 'Média ' || regiao
        FROM shares JOIN estado USING (sigla_uf)
        WHERE dimensao = '2-HIGH'
        AND regiao = (SELECT regiao FROM estado WHERE sigla_uf = 'NATION_3') GROUP BY ano, regiao
      UNION ALL SELECT ano, round(avg(valor), 8), 'Média Brasil'
        FROM shares WHERE dimensao = '2-HIGH' GROUP BY ano"""),
)
def focus_series(spark, d):
    chosen = filters.choose_dimension(shares(spark, d), "dimensao", "2-HIGH")
    series = compare.focus_series(chosen, src.states(spark, d), "NATION_3", ["NATION_7", "NATION_20"])
    return to_digits(series, 8, "valor").orderBy("serie", "ano")


# --- terms of office ------------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT conv_id, role, turn, text FROM conversations
       QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) = 1""",
)
def latest_per_key(spark, d):
    return tenure.latest_per_key(src.table(spark, d, "conversations"), ["conv_id", "role"], ["turn"])


def turns(spark, d):
    """Last turn of each speaker, flagged where a conversation has more than two."""
    last = latest_per_key(spark, d).drop("text")
    return tenure.flag_conflicts(last, ["conv_id"], "role", "conflito")


@query(
    "conflict_flag",
    """SELECT conv_id, role, max(turn) AS turn, count(*) OVER (PARTITION BY conv_id) > 1 AS conflito
       FROM conversations GROUP BY conv_id, role""",
)
def conflict_flag(spark, d):
    return turns(spark, d)


@query(
    "known_exceptions",
    """SELECT conv_id FROM (SELECT conv_id, count(DISTINCT role) AS n FROM conversations GROUP BY 1)
       WHERE n > 1 AND conv_id NOT IN (0, 2, 5, 7)""",
)
def known_exceptions(spark, d):
    known = literal_frame(spark, [(0,), (2,), (5,), (7,)], "conv_id BIGINT")
    return tenure.unknown_conflicts(turns(spark, d), known, ["conv_id"], "conflito")


TERMS = """terms AS (SELECT sigla_uf, eleicao, eleicao = 1998 AND regiao = 'ASIA' AS revisao,
    CASE WHEN NOT (eleicao = 1998 AND regiao = 'ASIA') THEN make_date(eleicao + 1, 1, 1) END AS inicio_mandato,
    CASE WHEN NOT (eleicao = 1998 AND regiao = 'ASIA') THEN make_date(eleicao + 4, 12, 31) END AS fim_mandato
  FROM estado, (VALUES (1994), (1998)) v(eleicao))"""


def on_terms(select, *more):
    return with_ctes("estado", *more, select=f"SELECT * FROM (WITH {TERMS} {select})")


def terms(spark, d):
    """Two elections per state; one region's second one needs review."""
    elections = src.states(spark, d).select(
        "sigla_uf", "regiao", F.explode(F.array(F.lit(1994), F.lit(1998))).alias("eleicao")
    )
    flagged = elections.withColumn("revisao", (F.col("eleicao") == 1998) & (F.col("regiao") == "ASIA"))
    return tenure.add_term_dates(flagged.drop("regiao"), "eleicao", "revisao", "inicio_mandato", "fim_mandato")


@query("term_dates", on_terms("SELECT * FROM terms"))
def term_dates(spark, d):
    return terms(spark, d)


@query(
    "band_index",
    on_terms("""SELECT sigla_uf, year(inicio_mandato)::INTEGER AS ano_inicio,
        year(fim_mandato)::INTEGER AS ano_fim, sigla_uf || ' (P' || eleicao || ')' AS rotulo,
        ((row_number() OVER (PARTITION BY sigla_uf ORDER BY inicio_mandato) - 1) % 2)::INTEGER AS faixa
      FROM terms WHERE NOT revisao"""),
)
def band_index(spark, d):
    named = terms(spark, d).select(
        "*",
        F.concat("sigla_uf", F.lit(" da Silva")).alias("nome_candidato"),
        F.concat(F.lit("P"), F.col("eleicao").cast("string")).alias("sigla_partido"),
        F.col("revisao").alias("requer_revisao_manual"),
    )
    return tenure.term_bands(named)


ASSIGNED = """SELECT f.ano, f.sigla_uf, dimensao, valor, eleicao FROM purchases f
  LEFT JOIN terms t ON f.sigla_uf = t.sigla_uf
  AND f.ano BETWEEN year(inicio_mandato) AND year(fim_mandato)"""


def assigned(spark, d):
    return tenure.assign_term(src.purchases(spark, d), terms(spark, d), ["eleicao"])


@query("assign_term", on_terms(ASSIGNED, "purchases"))
def assign_term(spark, d):
    return assigned(spark, d)


@query(
    "term_change",
    on_terms(
        f"""SELECT sigla_uf, dimensao, eleicao, min(ano) AS primeiro_ano, max(ano) AS ultimo_ano,
            arg_min(valor, ano) AS valor_inicial, arg_max(valor, ano) AS valor_final,
            arg_max(valor, ano) - arg_min(valor, ano) AS variacao
          FROM ({ASSIGNED}) WHERE eleicao IS NOT NULL GROUP BY ALL""",
        "purchases",
    ),
)
def term_change(spark, d):
    known = assigned(spark, d).where(F.col("eleicao").isNotNull())
    return tenure.term_change(known, ["sigla_uf", "dimensao", "eleicao"])


# --- association ----------------------------------------------------------------

BALANCES = "balances AS (SELECT ano, sigla_uf, avg(saldo) AS saldo FROM placed GROUP BY ALL)"


def on_balances(select, more=""):
    return with_ctes("purchases", select=f"SELECT * FROM (WITH {BALANCES}{more} {select})")


def balances(spark, d):
    return src.placed(spark, d).groupBy("ano", "sigla_uf").agg(F.avg("saldo").alias("saldo"))


def pairs(spark, d, lag):
    """Spending per priority against the mean balance of the ordering customers."""
    return association.lagged_pairs(src.purchases(spark, d), balances(spark, d), ["sigla_uf"], "ano", lag)


@query(
    "lag_join",
    on_balances("""SELECT b.ano, b.sigla_uf, dimensao, valor, saldo FROM purchases p
                   JOIN balances b ON p.sigla_uf = b.sigla_uf AND p.ano + 2 = b.ano"""),
)
def lag_join(spark, d):
    return pairs(spark, d, 2)


@query(
    "pearson_by",
    on_balances("""SELECT sigla_uf, dimensao, n, CASE WHEN NOT isnan(r) THEN round_even(r, 3) END AS correlacao
      FROM (SELECT p.sigla_uf, dimensao, count(*) AS n, corr(valor, saldo) AS r
        FROM purchases p JOIN balances b ON p.sigla_uf = b.sigla_uf AND p.ano = b.ano GROUP BY ALL)
      WHERE n >= 3"""),
)
def pearson_by(spark, d):
    return association.pearson_by(pairs(spark, d, 0), ["sigla_uf", "dimensao"], "valor", "saldo")


# Two-sided normal p-value from the error function's series of positive terms.
P_VALUE = """round_even(CASE WHEN z > 5 THEN 0.0 ELSE 1 - exp(-z * z) * list_sum([
    z ** (2 * i + 1) / gamma(i + 1.5) FOR i IN range(0, 120)]) END, 4)"""

# The same regression by another way: centre on states and years in turn until nothing moves.
SWEPT = """
  swept(k, dimensao, sigla_uf, ano, x, y) AS (
    SELECT 0, dimensao, sigla_uf, ano, x, y FROM panel
    UNION ALL
    SELECT k + 1, dimensao, sigla_uf, ano,
      x - avg(x) OVER (PARTITION BY dimensao, ano), y - avg(y) OVER (PARTITION BY dimensao, ano)
    FROM (SELECT k, dimensao, sigla_uf, ano,
        x - avg(x) OVER (PARTITION BY dimensao, sigla_uf) AS x,
        y - avg(y) OVER (PARTITION BY dimensao, sigla_uf) AS y FROM swept)
    WHERE k < 60),
  centred AS (SELECT * FROM swept WHERE k = 60),
  slopes AS (SELECT dimensao, sum(x * y) / sum(x * x) AS b, sum(x * x) AS sxx, count(*) AS n,
      count(DISTINCT sigla_uf) AS g, count(DISTINCT ano) AS t FROM centred GROUP BY 1),
  meat AS (SELECT dimensao, sum(s * s) AS m FROM (
      SELECT dimensao, sigla_uf, sum(x * (y - b * x)) AS s
      FROM centred JOIN slopes USING (dimensao) GROUP BY ALL) GROUP BY 1),
  fitted AS (SELECT dimensao, n, g, b,
      sqrt(g / (g - 1) * (n - 1) / (n - g - t) * m) / sxx AS se
    FROM slopes JOIN meat USING (dimensao)),
  tested AS (SELECT *, abs(b / se) / sqrt(2) AS z FROM fitted)
  SELECT dimensao, n AS n_obs, g AS n_entities, {effect} AS efeito, {error} AS erro_padrao,
    """ + P_VALUE + """ AS valor_p,
    CASE WHEN n < 30 OR g < 5 THEN 'Dados insuficientes para rodar a regressão com confiança'
      WHEN z >= 1.959963984540054 / sqrt(2) AND b < 0 THEN
        'Estatisticamente significativo (p<0,05): aumento no gasto associado a reduz o indicador'
      WHEN z >= 1.959963984540054 / sqrt(2) THEN
        'Estatisticamente significativo (p<0,05): aumento no gasto associado a aumenta o indicador'
      ELSE 'Não significativo — não há evidência estatística suficiente' END AS interpretacao
  FROM tested"""


def sweeps(effect="round(b, 5)", error="round(se, 5)", rounds=60):
    """The regression's CTEs and result; ``effect`` and ``error`` round it, once."""
    return SWEPT.replace("{effect}", effect).replace("{error}", error).replace("k < 60", f"k < {rounds}").replace("k = 60", f"k = {rounds}")


def on_panel(cause, x, where=""):
    return with_ctes(
        "purchases",
        select=f"""SELECT * FROM (WITH RECURSIVE {BALANCES}, {SHARES},
          panel AS (SELECT dimensao, p.sigla_uf, p.ano, {x} AS x, saldo / 1e3 AS y
            FROM {cause} p JOIN balances b ON p.sigla_uf = b.sigla_uf AND p.ano = b.ano {where}),
          {sweeps()})""",
    )


def balanced_shares(spark, d):
    return association.lagged_pairs(shares(spark, d), balances(spark, d), ["sigla_uf"], "ano", 0)


def slopes(panel):
    panel = panel.withColumn("y", F.col("saldo") / 1e3)
    out = fixed_effects_by(panel, ["dimensao"], "sigla_uf", "ano", "x", "y", digits=None)
    rounded = to_digits(out, 5, "efeito", "erro_padrao")
    return rounded.withColumn("valor_p", F.bround("valor_p", 4))


@query("fixed_effects", on_panel("purchases", "valor / 1e6"))
def fixed_effects(spark, d):
    return slopes(pairs(spark, d, 0).withColumn("x", F.col("valor") / 1e6))


@query("fixed_effects_unbalanced", on_panel("shares", "valor", "WHERE valor > 18.5 AND saldo > 420000"))
def fixed_effects_unbalanced(spark, d):
    """A panel with holes: high shares of state-years with a high balance."""
    held = balanced_shares(spark, d).where((F.col("valor") > 18.5) & (F.col("saldo") > 420_000))
    return slopes(held.withColumn("x", F.col("valor")))


WEEKLY = """(SELECT 'todas' AS dimensao, sigla_uf, datediff('day', DATE '1995-01-01', o_orderdate::DATE) // 7 AS ano,
    sum(valor) / 1e6 AS x, avg(saldo) / 1e3 AS y FROM placed GROUP BY ALL)"""


@query(
    "fixed_effects_weekly",
    with_ctes(
        "placed",
        select=f"SELECT * FROM (WITH RECURSIVE panel AS {WEEKLY}, {sweeps(rounds=250)})",
    ),
)
def fixed_effects_weekly(spark, d):
    """Order value against mean balance with an effect for every state and every week of seven years."""
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    weekly = src.placed(spark, d).groupBy(F.lit("todas").alias("dimensao"), "sigla_uf", F.floor(days / 7).alias("semana")).agg(
        (F.sum("valor") / 1e6).alias("x"), (F.avg("saldo") / 1e3).alias("y")
    )
    out = fixed_effects_long(weekly, ["dimensao"], "sigla_uf", "semana", "x", "y", digits=None)
    return to_digits(out, 5, "efeito", "erro_padrao").withColumn("valor_p", F.bround("valor_p", 4))


# --- checks ---------------------------------------------------------------------


@query(
    "coverage_gaps",
    with_ctes(
        "placed",
        select="""SELECT sigla_uf, ano::INTEGER AS ano FROM estado, range(1994, 2003) r(ano)
          WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.sigla_uf = estado.sigla_uf AND p.ano = r.ano
            AND valor > 49250000)""",
    ),
)
def coverage_gaps(spark, d):
    present = src.placed(spark, d).where(F.col("valor") > 49_250_000).select("sigla_uf", "ano").distinct()
    return quality.coverage_gaps(present, src.states(spark, d), 1994, 2002)


@query(
    "coverage",
    with_ctes(
        "placed",
        select="""SELECT o_orderpriority AS id_indicador, ano, count(DISTINCT sigla_uf) AS presentes,
          count(DISTINCT sigla_uf) >= 25 AS completo FROM placed WHERE valor > 45000000 GROUP BY ALL""",
    ),
)
def coverage(spark, d):
    facts = src.placed(spark, d).where(F.col("valor") > 45_000_000)
    return quality.coverage(facts.withColumnRenamed("o_orderpriority", "id_indicador"), 25)


@query(
    "plausibility",
    on_shares("""SELECT sigla_uf, ano, dimensao, round(valor, 8) AS valor FROM shares
      WHERE (dimensao = '1-URGENT' AND (valor < 10 OR valor > 25)) OR (dimensao = '5-LOW' AND valor > 22)"""),
)
def plausibility(spark, d):
    rules = literal_frame(spark, [("1-URGENT", 10.0, 25.0), ("5-LOW", None, 22.0)], quality.RULES)
    facts = shares(spark, d).withColumn("id_indicador", F.col("dimensao"))
    outside = quality.plausibility_violations(facts, rules)
    return to_digits(outside.select("sigla_uf", "ano", "dimensao", "valor"), 8, "valor")


@query(
    "validity_cut",
    with_ctes("purchases", select="SELECT * FROM purchases WHERE dimensao <> '3-MEDIUM' OR ano <= 1998"),
)
def validity_cut(spark, d):
    facts = src.purchases(spark, d).withColumn("id_indicador", F.col("dimensao"))
    return quality.within_validity(facts, spark, {"3-MEDIUM": 1998}).drop("id_indicador")


@query(
    "unmapped_keys",
    with_ctes(
        "purchases",
        select="""SELECT ano, sigla_uf, count(*) AS linhas FROM purchases
          WHERE sigla_uf NOT IN (SELECT sigla_uf FROM estado WHERE regiao <> 'ASIA') GROUP BY ALL""",
    ),
)
def unmapped_keys(spark, d):
    known = src.states(spark, d).where(F.col("regiao") != "ASIA").select("sigla_uf", "nome_uf")
    looked_up = lookups.map_codes(src.purchases(spark, d), known, "sigla_uf", "nome_uf", "nome")
    missing = lookups.unmapped(looked_up, "nome")
    return missing.groupBy("ano", "sigla_uf").agg(F.count(F.lit(1)).alias("linhas"))
