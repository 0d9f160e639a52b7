"""Scans, filters, measures and reshaping."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civicpanel.functions import expressions as ex
from civicpanel.functions.parameters import Years
from civicpanel.operators import compare, filters, longform, lookups, measures
from civicpanel.sources.frames import literal_frame
from civicpanel.sources.scratch import shared_folder
from civicpanel.sources.tables import read_states
from workload import inputs as src
from workload.inputs import with_ctes
from workload.registry import query


@query(
    "scan_project_filter",
    """SELECT o_orderkey AS pedido, o_orderpriority AS funcao, o_totalprice AS valor
       FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'
       AND o_orderstatus = 'F'""",
)
def scan_project_filter(spark, d):
    return (
        src.table(spark, d, "orders")
        .where(ex.years_between("o_orderdate", 1996, 1998) & (F.col("o_orderstatus") == "F"))
        .select(
            F.col("o_orderkey").alias("pedido"),
            F.col("o_orderpriority").alias("funcao"),
            F.col("o_totalprice").alias("valor"),
        )
    )


@query(
    "code_pattern_total",
    """SELECT p_brand, sum(round(p_retailprice * 100)) AS valor FROM part
       WHERE p_type LIKE 'S%' AND p_type <> 'SMALL'
       AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#12', 'Brand#20') GROUP BY p_brand""",
)
def code_pattern_total(spark, d):
    wanted = "Brand#1, Brand#2,Brand#12 , Brand#20".split(",")
    part = src.table(spark, d, "part").where(ex.subtotal_code("p_type", "S%", "SMALL"))
    chosen = filters.keep_members(part, "p_brand", [w.strip() for w in wanted])
    return measures.sum_by(chosen.withColumn("valor", src.cents("p_retailprice")), ["p_brand"], "valor", "valor")


@query(
    "code_range_rate",
    with_ctes(
        "shipped",
        select="""SELECT a.ano, a.sigla_uf, linhas, pedidos, linhas::DOUBLE / pedidos * 1000 AS taxa
          FROM (SELECT ano, sigla_uf, count(*) AS linhas FROM shipped
                WHERE substr(p_brand, 1, 8) BETWEEN 'Brand#12' AND 'Brand#19' GROUP BY ALL) a
          LEFT JOIN (SELECT ano, sigla_uf, count(*) AS pedidos FROM placed GROUP BY ALL) b
          ON a.ano = b.ano AND a.sigla_uf = b.sigla_uf""",
    ),
)
def code_range_rate(spark, d):
    by = ["ano", "sigla_uf"]
    lines = src.shipped(spark, d).where(ex.code_between("p_brand", "Brand#12", "Brand#19"))
    return measures.rate(
        measures.count_by(lines, by, "linhas"),
        measures.count_by(src.placed(spark, d), by, "pedidos"),
        by,
        "linhas",
        "pedidos",
        1000,
        "taxa",
    )


@query(
    "null_age_predicate",
    """SELECT year(o_orderdate)::INTEGER AS ano, count(*) AS n
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       WHERE CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END = 0
       OR (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END IS NULL
           AND l_shipdate IS NOT NULL
           AND datediff('day', o_orderdate::DATE, l_shipdate::DATE) < 365)
       GROUP BY 1""",
)
def null_age_predicate(spark, d):
    orders, line = src.table(spark, d, "orders"), src.table(spark, d, "lineitem")
    rows = orders.join(line, orders.o_orderkey == line.l_orderkey, "left").select(
        F.year("o_orderdate").alias("ano"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).alias("idade"),
        F.col("o_orderdate").alias("nascimento"),
        F.col("l_shipdate").alias("obito"),
    )
    return measures.count_by(rows.where(ex.died_under_one("idade", "nascimento", "obito")), ["ano"], "n")


@query(
    "ratio_left_zero",
    with_ctes(
        "placed",
        select="""SELECT t.ano, t.sigla_uf, todos, coalesce(caros, 0) AS caros,
            coalesce(caros, 0)::DOUBLE / todos * 1000 AS taxa
          FROM (SELECT ano, sigla_uf, count(*) AS todos FROM placed GROUP BY ALL) t
          LEFT JOIN (SELECT ano, sigla_uf, count(*) AS caros FROM placed
                     WHERE valor > 49250000 GROUP BY ALL) c
          ON t.ano = c.ano AND t.sigla_uf = c.sigla_uf""",
    ),
)
def ratio_left_zero(spark, d):
    by, rows = ["ano", "sigla_uf"], src.placed(spark, d)
    return measures.rate_or_zero(
        measures.count_by(rows.where(F.col("valor") > 49_250_000), by, "caros"),
        measures.count_by(rows, by, "todos"),
        by,
        "caros",
        "todos",
        1000,
        "taxa",
    )


@query(
    "per_capita",
    """SELECT c_nationkey, valor, clientes, valor / clientes * 1000 AS por_cliente
       FROM (SELECT c_nationkey, sum(round(o_totalprice * 100)) AS valor
             FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
       JOIN (SELECT c_nationkey, count(*) AS clientes FROM customer GROUP BY 1) USING (c_nationkey)""",
)
def per_capita(spark, d):
    orders, customer = src.table(spark, d, "orders"), src.table(spark, d, "customer")
    bought = orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn(
        "valor", src.cents("o_totalprice")
    )
    return measures.rate(
        measures.sum_by(bought, ["c_nationkey"], "valor", "valor"),
        measures.count_by(customer, ["c_nationkey"], "clientes"),
        ["c_nationkey"],
        "valor",
        "clientes",
        1000,
        "por_cliente",
        how="inner",
    )


@query(
    "weighted_mean",
    with_ctes(
        "sanitation",
        select="""SELECT ano, sigla_uf,
            sum(indice_atendimento_total_agua * populacao_urbana) / sum(populacao_urbana) AS agua,
            sum(indice_coleta_esgoto * populacao_urbana) / sum(populacao_urbana) AS esgoto
          FROM sanitation WHERE populacao_urbana > 0 GROUP BY ALL""",
    ),
)
def weighted_mean(spark, d):
    values = {"agua": "indice_atendimento_total_agua", "esgoto": "indice_coleta_esgoto"}
    return measures.weighted_mean(src.sanitation(spark, d), ["ano", "sigla_uf"], values, "populacao_urbana")


@query(
    "weighted_mean_exclude",
    with_ctes(
        "sanitation",
        select="""SELECT ano, sigla_uf,
            sum(indice_atendimento_total_agua * populacao_urbana)
              / sum(CASE WHEN indice_atendimento_total_agua IS NOT NULL THEN populacao_urbana END) AS agua
          FROM sanitation WHERE populacao_urbana > 0 GROUP BY ALL""",
    ),
)
def weighted_mean_exclude(spark, d):
    return measures.weighted_mean(
        src.sanitation(spark, d),
        ["ano", "sigla_uf"],
        {"agua": "indice_atendimento_total_agua"},
        "populacao_urbana",
        null_policy="exclude",
    )


@query(
    "yearly_mean_count",
    with_ctes(
        "quarters",
        select="""SELECT cod_uf, substr(periodo, 1, 4)::INTEGER AS ano, avg(valor) AS media,
            count(valor) AS trimestres, sum(substr(periodo, 5, 2)::INTEGER)::BIGINT AS soma_trimestres
          FROM quarters GROUP BY ALL""",
    ),
)
def yearly_mean_count(spark, d):
    quarters = src.quarters(src.placed(spark, d)).withColumn("ano", ex.period_year("periodo"))
    numbered = quarters.withColumn("trimestre", ex.period_quarter("periodo"))
    return measures.mean_with_count(
        numbered, ["cod_uf", "ano"], "valor", "media", "trimestres", soma_trimestres=F.sum("trimestre")
    )


LAGGED = """lagged AS (SELECT *, lag(acumulado) OVER w AS antes, lag(dia) OVER w AS dia_antes
  FROM running WINDOW w AS (PARTITION BY user_id, event_type ORDER BY dia))"""


@query(
    "increments_gaps",
    with_ctes(
        "running",
        select="SELECT * FROM (WITH " + LAGGED + """
          SELECT event_type, dia,
            sum(CASE WHEN acumulado - antes IS NOT NULL THEN greatest(acumulado - antes, 0) END) AS passo,
            count(*) AS series
          FROM lagged WHERE antes IS NOT NULL AND dia_antes = dia - 1 GROUP BY ALL)""",
    ),
)
def increments_gaps(spark, d):
    steps = measures.increments(
        src.running(spark, d), ["user_id", "event_type"], "dia", "acumulado", "passo"
    )
    return steps.groupBy("event_type", "dia").agg(
        F.sum("passo").alias("passo"), F.count(F.lit(1)).alias("series")
    )


@query(
    "increment_status",
    with_ctes(
        "running",
        select="SELECT * FROM (WITH " + LAGGED + """
          SELECT event_type,
            CASE WHEN dia_antes IS NULL THEN 'first' WHEN dia_antes <> dia - 1 THEN 'gap'
                 WHEN acumulado < antes THEN 'decrease' ELSE 'kept' END AS situacao,
            count(*) AS linhas FROM lagged GROUP BY ALL)""",
    ),
)
def increment_status(spark, d):
    """The two lags of one window, as an audit of what the increments leave out."""
    rows = measures.previous_step(src.running(spark, d), ["user_id", "event_type"], "dia", "acumulado")
    return measures.count_by(rows, ["event_type", "situacao"], "linhas")


@query(
    "increments_by_nation",
    with_ctes(
        "deforestation",
        "municipalities",
        select="""SELECT ano, sigla_uf, sum(greatest(passo, 0)) AS passo FROM (
            SELECT ano, id_municipio,
              desmatado - lag(desmatado) OVER w AS passo, lag(ano) OVER w AS antes
            FROM deforestation WHERE ano BETWEEN 1995 AND 2000
            WINDOW w AS (PARTITION BY id_municipio, bioma ORDER BY ano))
          JOIN municipalities USING (id_municipio)
          WHERE passo IS NOT NULL AND antes = ano - 1 AND ano >= 1996 GROUP BY ALL""",
    ),
)
def increments_by_nation(spark, d):
    steps = measures.increments(
        src.deforestation(spark, d), ["id_municipio", "bioma"], "ano", "desmatado", "passo", 1996, 2000
    )
    placed = steps.join(src.municipalities(spark, d), "id_municipio")
    return measures.sum_by(placed, ["ano", "sigla_uf"], "passo", "passo")


LONG = """(SELECT ano, sigla_uf, '1_valor' AS id_indicador, '' AS dimensao, sum(valor) AS valor
   FROM placed GROUP BY ALL
 UNION ALL SELECT ano, sigla_uf, '2_pedidos', '', count(*)::DOUBLE FROM placed GROUP BY ALL
 UNION ALL SELECT ano, sigla_uf, '3_saldo', '', avg(saldo) FROM placed GROUP BY ALL
 UNION ALL SELECT ano, sigla_uf, '4_prioridade', o_orderpriority, sum(valor) FROM placed GROUP BY ALL)"""


def long_facts(spark, d):
    """Four indicators in long form; one of them is keyed by state code."""
    rows = src.placed(spark, d)
    codes = src.states(spark, d)
    totals = rows.groupBy("ano", "sigla_uf").agg(
        F.sum("valor").alias("total"), F.count(F.lit(1)).alias("pedidos")
    )
    balance = rows.groupBy("ano", "cod_uf").agg(F.avg("saldo").alias("saldo"))
    return longform.stack(
        [
            longform.measures_to_long(totals, {"total": ("1_valor", ""), "pedidos": ("2_pedidos", "")}),
            longform.to_long(lookups.resolve_state(balance, codes), "3_saldo", "saldo"),
            longform.to_long(src.purchases(spark, d), "4_prioridade", "valor", dimension=F.col("dimensao")),
        ]
    )


@query("to_long_union", with_ctes("placed", select=f"SELECT * FROM {LONG}"))
def to_long_union(spark, d):
    return long_facts(spark, d)


@query(
    "indicator_counts",
    with_ctes("placed", select=f"SELECT id_indicador, count(*) AS linhas FROM {LONG} GROUP BY 1"),
)
def indicator_counts(spark, d):
    return longform.rows_per_indicator(long_facts(spark, d))


@query(
    "unpivot_measures",
    with_ctes(
        "placed",
        select="""SELECT ano, sigla_uf, dimensao, valor FROM (
            SELECT ano, sigla_uf, sum(valor) AS soma, avg(valor) AS media,
                   min(valor) AS menor, max(valor) AS maior FROM placed GROUP BY ALL)
          UNPIVOT (valor FOR dimensao IN (soma, media, menor, maior))""",
    ),
)
def unpivot_measures(spark, d):
    wide = src.placed(spark, d).groupBy("ano", "sigla_uf").agg(
        F.sum("valor").alias("s"), F.avg("valor").alias("a"), F.min("valor").alias("lo"), F.max("valor").alias("hi")
    )
    labels = {"s": "soma", "a": "media", "lo": "menor", "hi": "maior"}
    return longform.unpivot_measures(wide, ["ano", "sigla_uf"], labels, "dimensao", "valor")


@query(
    "json_props",
    """SELECT event_type, avg(json_extract(props, '$.k')::INTEGER) AS media, count(*) AS n
       FROM events GROUP BY 1""",
)
def json_props(spark, d):
    parsed = src.table(spark, d, "events").select("event_type", F.from_json("props", "k INT").alias("p"))
    return parsed.groupBy("event_type").agg(F.avg("p.k").alias("media"), F.count(F.lit(1)).alias("n"))


@query(
    "keyword_search",
    """SELECT p_partkey, p_name FROM part
       WHERE lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%'""",
)
def keyword_search(spark, d):
    part = src.table(spark, d, "part")
    return part.where(ex.mentions_any("p_name", ("RED", "Ring", "bolt"))).select("p_partkey", "p_name")


@query("distinct_dims", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_dims(spark, d):
    return compare.distinct_combinations(src.table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@query("distinct_sorted", "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> '' ORDER BY 1")
def distinct_sorted(spark, d):
    return compare.distinct_values(src.table(spark, d, "customer"), "c_mktsegment")


@query(
    "first_token_label",
    """SELECT p_partkey, string_split_regex(trim(p_name), '\\s+')[1] || ' (' || p_brand || ')' AS rotulo
       FROM part""",
)
def first_token_label(spark, d):
    return src.table(spark, d, "part").select("p_partkey", ex.name_and_party("p_name", "p_brand").alias("rotulo"))


@query(
    "preview_top_n",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def preview_top_n(spark, d):
    orders = src.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "set_difference",
    """SELECT o_custkey, year(o_orderdate)::INTEGER AS ano FROM orders WHERE o_orderpriority = '1-URGENT'
       EXCEPT SELECT o_custkey, year(o_orderdate)::INTEGER FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def set_difference(spark, d):
    """Customers with an urgent order in a year and no low one."""
    rows = src.table(spark, d, "orders").withColumn("ano", F.year("o_orderdate"))

    def of(priority):
        return rows.where(F.col("o_orderpriority") == priority).select("o_custkey", "ano")

    return lookups.without_known(of("1-URGENT"), of("5-LOW"), ["o_custkey", "ano"])


@query(
    "key_lookup",
    with_ctes(
        "estado",
        select="""SELECT c_custkey, c_nationkey::VARCHAR AS codigo, n.nome AS nome_ou_nulo,
            coalesce(n.nome, c_nationkey::VARCHAR) AS nome_ou_codigo
          FROM (SELECT DISTINCT c_custkey, c_nationkey FROM customer)
          LEFT JOIN (SELECT n_nationkey, nome_uf AS nome FROM estado WHERE regiao <> 'ASIA') n
          ON c_nationkey = n.n_nationkey""",
    ),
)
def key_lookup(spark, d):
    """Codes of one region are left out of the map."""
    mapping = (
        src.states(spark, d)
        .where(F.col("regiao") != "ASIA")
        .select(F.col("n_nationkey").cast("string").alias("codigo"), F.col("nome_uf").alias("nome"))
    )
    customer = src.table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("codigo")
    )
    known = lookups.map_codes(customer.distinct(), mapping, "codigo", "nome", "nome_ou_nulo")
    return lookups.map_codes(known, mapping, "codigo", "nome", "nome_ou_codigo", keep_unknown=True)


@query(
    "scalar_bundle",
    """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         datediff('day', o_orderdate::DATE, l_shipdate::DATE)::INTEGER AS dias,
         substr(o_orderpriority, 1, 3) AS prefixo,
         o_orderpriority LIKE '%-%W' AS padrao,
         round_even(l_quantity / 8, 2) AS arredondado,
         o_orderkey::VARCHAR AS chave, l_quantity::INTEGER AS quantidade,
         trim(string_split(p_name, ' ')[2]) AS segunda,
         [trim(x) FOR x IN string_split(o_orderpriority || ' , ' || o_orderstatus, ',')][2] AS item
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
)
def scalar_bundle(spark, d):
    orders, line, part = (src.table(spark, d, t) for t in ("orders", "lineitem", "part"))
    rows = orders.join(line, orders.o_orderkey == line.l_orderkey).join(part, line.l_partkey == part.p_partkey)
    return rows.select(
        "o_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.datediff("l_shipdate", "o_orderdate").alias("dias"),
        F.substring("o_orderpriority", 1, 3).alias("prefixo"),
        F.col("o_orderpriority").like("%-%W").alias("padrao"),
        ex.round_half_even(F.col("l_quantity") / 8, 2).alias("arredondado"),
        F.col("o_orderkey").cast("string").alias("chave"),
        F.col("l_quantity").cast("int").alias("quantidade"),
        F.trim(F.get(F.split("p_name", " "), F.lit(1))).alias("segunda"),
        F.get(
            ex.trimmed_list(F.concat("o_orderpriority", F.lit(" , "), "o_orderstatus")), F.lit(1)
        ).alias("item"),
    )


@query(
    "year_specification",
    with_ctes(
        "placed",
        select="""SELECT ano, sum(valor) AS valor, count(*) AS n FROM placed
          WHERE ano IN (1996, 1999) GROUP BY 1""",
    ),
)
def year_specification(spark, d):
    rows = src.table(spark, d, "orders").where(Years.parse("1996,1999").covers("o_orderdate"))
    return rows.groupBy(F.year("o_orderdate").alias("ano")).agg(
        F.sum(src.cents("o_totalprice")).alias("valor"), F.count(F.lit(1)).alias("n")
    )


@query(
    "missing_years",
    """SELECT ano::INTEGER AS ano FROM range(1990, 2006) r(ano)
       WHERE ano NOT IN (SELECT year(o_orderdate) FROM orders)""",
)
def missing_years(spark, d):
    seen = src.table(spark, d, "orders").select(F.year("o_orderdate").alias("ano")).distinct()
    return lookups.missing_years(seen, 1990, 2005)


@query(
    "covered_years",
    """SELECT DISTINCT year(o_orderdate)::INTEGER AS ano, 'c' || year(o_orderdate) AS id_categoria
       FROM orders WHERE year(o_orderdate) BETWEEN 1990 AND 1998""",
)
def covered_years(spark, d):
    """The categories of the requested years that exist."""
    year = F.year("o_orderdate")
    mapping = src.table(spark, d, "orders").select(year.alias("ano"), F.concat(F.lit("c"), year).alias("id_categoria"))
    return lookups.covered_years(mapping.distinct(), 1990, 1998)


@query(
    "dimension_sorted",
    with_ctes("estado", select="SELECT cod_uf, sigla_uf, nome_uf, regiao FROM estado ORDER BY nome_uf"),
)
def dimension_sorted(spark, d):
    """Through the reader of the stored dimension."""
    folder = f"{shared_folder(spark)}/civicpanel/star-{uuid.uuid4().hex}"
    src.states(spark, d).drop("n_nationkey").write.parquet(f"{folder}/dim_estado")
    return read_states(spark, folder)


@query(
    "catalogue_matches",
    """SELECT o_orderpriority AS nome, CASE o_orderpriority WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h' END
         AS unidade, count(*) AS n FROM orders GROUP BY ALL""",
)
def catalogue_matches(spark, d):
    """A small in-code dimension joined to a large table."""
    units = literal_frame(spark, [("1-URGENT", "u"), ("2-HIGH", "h")], "nome STRING, unidade STRING")
    rows = src.table(spark, d, "orders").select(F.col("o_orderpriority").alias("nome"))
    return measures.count_by(rows, ["nome"], "n").join(units, "nome", "left")
