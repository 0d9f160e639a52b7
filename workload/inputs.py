"""The library's input tables, derived by Spark from the test tables.

Nations stand for states, their regions for regions, the order year for the year. Money
is counted in cents: whole numbers in doubles, whose sums do not depend on their order.
``CTES`` holds the same derivations as SQL common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicpanel.functions.expressions import in_years, years_between
from civicpanel.operators import distinct, rollup
from civicpanel.operators.lookups import with_group_values
from civicpanel.operators.measures import sum_by
from civicpanel.plans import indicators as ind
from civicpanel.sources.scratch import stored
from civicpanel.sources.tables import read_table

CTES: dict[str, str] = {}

# Stated, so that building a plan reads no file footer.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet", SCHEMAS[name])


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100)


def with_ctes(*names: str, select: str) -> str:
    """SQL text: the named derivations, their own inputs first, then the select."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES:
            if needed != name and needed in _NEEDS.get(name, ()):
                visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + select


_NEEDS = {
    "placed": ("estado",),
    "shipped": ("placed",),
    "deaths": ("shipped",),
    "gdp": ("placed",),
    "population": ("placed",),
    "per_head": ("placed",),
    "deforestation": (),
    "municipalities": (),
    "sanitation": ("shipped",),
    "spending": ("placed",),
    "schools": ("placed",),
    "development": ("placed",),
    "elections": ("placed",),
    "quarters": ("placed",),
    "purchases": ("placed",),
    "clients": (),
    "daily": (),
    "running": ("daily",),
}

# --- dimensions ----------------------------------------------------------------

CTES["estado"] = """
  SELECT lpad(n_nationkey::VARCHAR, 2, '0') AS cod_uf, n_name AS sigla_uf,
         'Estado ' || n_nationkey AS nome_uf, r_name AS regiao, n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


def states(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("cod_uf"),
        F.col("n_name").alias("sigla_uf"),
        F.concat(F.lit("Estado "), F.col("n_nationkey").cast("string")).alias("nome_uf"),
        F.col("r_name").alias("regiao"),
        "n_nationkey",
    )


# --- orders with state and year -------------------------------------------------

CTES["placed"] = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
         round(o_totalprice * 100) AS valor, c_name, c_mktsegment,
         round(c_acctbal * 100) AS saldo,
         cod_uf, sigla_uf, nome_uf, regiao, year(o_orderdate)::INTEGER AS ano
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN estado ON c_nationkey = n_nationkey"""


def orders_of(
    spark: SparkSession, d: str, first: int | None = None, last: int | None = None, years: Sequence[int] | None = None
) -> DataFrame:
    """Orders, of a range or a list of years if given; both reach the scan."""
    orders = table(spark, d, "orders")
    if years is not None:
        return orders.where(in_years("o_orderdate", years))
    return orders if first is None else orders.where(years_between("o_orderdate", first, last))


def placed(
    spark: SparkSession, d: str, first: int | None = None, last: int | None = None, years: Sequence[int] | None = None
) -> DataFrame:
    """One row per order. ``pedidos``, ``menor_valor`` and ``maior_valor`` are its share in a rolled-up row."""
    orders, customer = orders_of(spark, d, first, last, years), table(spark, d, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        states(spark, d), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        cents("o_totalprice").alias("valor"), "c_name", "c_mktsegment",
        cents("c_acctbal").alias("saldo"),
        "cod_uf", "sigla_uf", "nome_uf", "regiao", F.year("o_orderdate").alias("ano"),
        F.quarter("o_orderdate").alias("trimestre"), F.lit(1).cast("long").alias("pedidos"),
        cents("o_totalprice").alias("menor_valor"), cents("o_totalprice").alias("maior_valor"),
    )


GRAIN = ["ano", "trimestre", "cod_uf", "sigla_uf", "nome_uf", "regiao", "o_orderpriority", "o_orderstatus", "c_mktsegment"]


#: How the measures of rolled-up orders merge.
STATES = {"valor": "sum", "pedidos": "sum", "menor_valor": "min", "maior_valor": "max"}


def rolled_up(spark: SparkSession, d: str) -> DataFrame:
    """Orders at the finest grain that a report needs, in the columns of ``placed``.

    One pass over the orders; every measure but the number of customers follows from it.
    """
    return stored(rollup.roll_up(placed(spark, d), GRAIN, STATES), "orders_rolled_up")


CTES["shipped"] = """
  SELECT l_returnflag, l_linenumber, l_shipdate, l_quantity, p_size, p_brand,
         round(l_discount * 100) AS desconto, round(l_tax * 100) AS imposto,
         o_orderstatus, o_orderdate, o_orderkey, sigla_uf, ano
  FROM lineitem JOIN placed ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey"""


def shipped(
    spark: SparkSession, d: str, first: int | None = None, last: int | None = None, with_part: bool = True
) -> DataFrame:
    """One row per order line, with columns of its part if asked for. The years are the order's."""
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    lines = line.join(part, line.l_partkey == part.p_partkey) if with_part else line
    return lines.join(placed(spark, d, first, last), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_returnflag", "l_linenumber", "l_shipdate", "l_quantity", *(["p_size", "p_brand"] if with_part else []),
        cents("l_discount").alias("desconto"), cents("l_tax").alias("imposto"),
        "o_orderstatus", "o_orderdate", "o_orderkey", "sigla_uf", "ano",
    )


# --- raw domain tables ----------------------------------------------------------

CTES["deaths"] = """
  SELECT ano, sigla_uf,
         CASE WHEN o_orderstatus = 'P' THEN 'fetal' ELSE 'nao-fetal' END AS tipo_obito,
         CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'R' THEN 1.0 END AS idade,
         CASE WHEN l_linenumber < 7 THEN o_orderdate::DATE END AS data_nascimento,
         l_shipdate::DATE AS data_obito,
         CASE WHEN p_size <= 25 THEN 'X' || (74 + p_size)
              ELSE 'Y' || lpad((p_size - 26)::VARCHAR, 2, '0') END || l_linenumber AS causa_basica
  FROM shipped"""


def death_columns() -> dict[str, Column]:
    """Order lines as deaths, with missing ages and missing birth dates."""
    size = F.col("p_size")
    cause = F.when(size <= 25, F.concat(F.lit("X"), (size + 74).cast("string"))).otherwise(
        F.concat(F.lit("Y"), F.lpad((size - 26).cast("string"), 2, "0"))
    )
    return {
        "tipo_obito": F.when(F.col("o_orderstatus") == "P", "fetal").otherwise("nao-fetal"),
        "idade": F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "R", 1.0),
        "data_nascimento": F.when(F.col("l_linenumber") < 7, F.col("o_orderdate").cast("date")),
        "data_obito": F.col("l_shipdate").cast("date"),
        "causa_basica": F.concat(cause, F.col("l_linenumber").cast("string")),
    }


def deaths(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    columns = [c.alias(n) for n, c in death_columns().items()]
    return shipped(spark, d, first, last).select("ano", "sigla_uf", *columns)


def infant_deaths(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Deaths without their cause, which is all that needs the part."""
    columns = [c.alias(n) for n, c in death_columns().items() if n != "causa_basica"]
    return shipped(spark, d, first, last, with_part=False).select("ano", "sigla_uf", *columns)


def births(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    return placed(spark, d, first, last).select("ano", "sigla_uf")


def links(rows: DataFrame) -> DataFrame:
    """Orders, or rolled-up orders, as employment links; ``pedidos`` says how many a row stands for."""
    active = F.when(F.col("o_orderstatus") == "F", "1").otherwise("0")
    return rows.select("ano", "sigla_uf", active.alias("vinculo_ativo_3112"), "pedidos")


CTES["gdp"] = """
  SELECT ano, cod_uf, nome_uf AS uf, sum(valor) AS pib_mil_reais FROM placed GROUP BY ALL"""
CTES["population"] = """
  SELECT ano, cod_uf, nome_uf AS uf, count(DISTINCT o_custkey)::DOUBLE AS populacao
  FROM placed GROUP BY ALL"""


def gdp(rows: DataFrame) -> DataFrame:
    return sum_by(rows.withColumnRenamed("nome_uf", "uf"), ["ano", "cod_uf", "uf"], "valor", "pib_mil_reais")


PLACES = ["ano", "cod_uf", "sigla_uf", "nome_uf", "regiao"]


def customers(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Which customers ordered, per year and state, as stored bitmaps. One pass over the orders."""
    return stored(distinct.bitmap_states(placed(spark, d, first, last), PLACES, "o_custkey"), "customers")


def population(states: DataFrame) -> DataFrame:
    """Ordering customers per state and year, from the bitmaps of ``customers``."""
    named = states.withColumnRenamed("nome_uf", "uf")
    counted = distinct.count_states(named, ["ano", "cod_uf", "uf"], "populacao")
    return counted.withColumn("populacao", F.col("populacao").cast("double"))


CTES["per_head"] = """
  SELECT ano, sigla_uf, count(DISTINCT o_custkey)::DOUBLE AS populacao FROM placed GROUP BY ALL"""


def per_head(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    return ind.state_population(population(customers(spark, d, first, last)), states(spark, d))


CTES["deforestation"] = """
  SELECT ano, id_municipio, bioma,
         sum(area) OVER (PARTITION BY id_municipio, bioma ORDER BY ano) AS desmatado
  FROM (SELECT year(l_shipdate)::INTEGER AS ano, l_suppkey::VARCHAR AS id_municipio,
               l_returnflag AS bioma, sum(l_quantity) AS area FROM lineitem GROUP BY ALL)"""
CTES["municipalities"] = """
  SELECT s_suppkey::VARCHAR AS id_municipio, n_name AS sigla_uf
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def deforestation(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative quantity per supplier, flag and year."""
    yearly = (
        table(spark, d, "lineitem")
        .groupBy(
            F.year("l_shipdate").alias("ano"),
            F.col("l_suppkey").cast("string").alias("id_municipio"),
            F.col("l_returnflag").alias("bioma"),
        )
        .agg(F.sum("l_quantity").alias("area"))
    )
    so_far = Window.partitionBy("id_municipio", "bioma").orderBy("ano")
    return yearly.select("ano", "id_municipio", "bioma", F.sum("area").over(so_far).alias("desmatado"))


def municipalities(spark: SparkSession, d: str) -> DataFrame:
    supplier, nation = table(spark, d, "supplier"), table(spark, d, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("id_municipio"), F.col("n_name").alias("sigla_uf")
    )


CTES["sanitation"] = """
  SELECT ano, sigla_uf,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 0
              ELSE l_quantity END AS populacao_urbana,
         CASE WHEN l_returnflag <> 'R' THEN desconto END AS indice_atendimento_total_agua,
         imposto AS indice_coleta_esgoto
  FROM shipped"""


def sanitation_columns() -> dict[str, Column]:
    """Lines as municipalities, with missing indices and missing or zero weights."""
    number = F.col("l_linenumber")
    return {
        "populacao_urbana": F.when(number == 6, 0.0).when(number != 7, F.col("l_quantity")),
        "indice_atendimento_total_agua": F.when(F.col("l_returnflag") != "R", F.col("desconto")),
        "indice_coleta_esgoto": F.col("imposto"),
    }


def sanitation(spark: SparkSession, d: str, first: int | None = None, last: int | None = None) -> DataFrame:
    columns = [c.alias(n) for n, c in sanitation_columns().items()]
    return shipped(spark, d, first, last, with_part=False).select("ano", "sigla_uf", *columns)


def rolled_up_lines(spark: SparkSession, d: str, first: int, last: int) -> tuple[DataFrame, DataFrame]:
    """Deaths with their number ``linhas``, and sanitation rows with summed weights, in one pass over the lines."""
    death, water = death_columns(), sanitation_columns()
    weight = water.pop("populacao_urbana")
    kind = {**{n: "string" for n in ("tipo_obito", "causa_basica")}, **{n: "double" for n in water}}

    def row(columns, lines, size):
        cells = [columns.get(n, F.lit(None)).cast(t).alias(n) for n, t in kind.items()]
        return F.struct(*cells, F.lit(lines).cast("long").alias("linhas"), size.alias("populacao_urbana"))

    rows = F.array_compact(F.array(row(death, 1, F.lit(None).cast("double")), F.when(weight > 0, row(water, 0, weight))))
    each = shipped(spark, d, first, last).select("ano", "sigla_uf", F.inline(rows))
    summed = each.groupBy("ano", "sigla_uf", *kind).agg(
        F.sum("linhas").alias("linhas"), F.sum("populacao_urbana").alias("populacao_urbana")
    )
    rolled = stored(summed, "lines_rolled_up")
    return rolled.where("tipo_obito IS NOT NULL"), rolled.where("tipo_obito IS NULL")


CTES["spending"] = """
  SELECT ano, sigla_uf,
         '3.0' || (substr(o_orderpriority, 1, 1)::INTEGER - 1) ||
           CASE WHEN o_orderstatus = 'P' THEN '.301' ELSE '.000' END AS id_conta_bd,
         o_orderpriority AS conta_bd,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Despesas Pagas'
              ELSE 'Despesas Liquidadas' END AS estagio_bd,
         valor
  FROM placed"""


def spending(rows: DataFrame) -> DataFrame:
    """Orders, or rolled-up orders, as account rows; one priority plays the grand total."""
    number = F.translate(F.substring("o_orderpriority", 1, 1), "12345", "01234")
    return rows.select(
        "ano",
        "sigla_uf",
        F.concat(
            F.lit("3.0"), number, F.when(F.col("o_orderstatus") == "P", ".301").otherwise(".000")
        ).alias("id_conta_bd"),
        F.col("o_orderpriority").alias("conta_bd"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Despesas Pagas")
        .otherwise("Despesas Liquidadas")
        .alias("estagio_bd"),
        "valor",
    )


CTES["schools"] = """
  SELECT ano, sigla_uf, CASE WHEN o_orderstatus = 'P' THEN 'municipal' ELSE 'estadual' END AS rede,
         c_mktsegment AS ensino, o_orderpriority AS anos_escolares,
         CASE WHEN max(valor) > 20000000 THEN avg(valor) END AS ideb, min(valor) AS taxa_aprovacao
  FROM placed GROUP BY ALL"""


def mean_value() -> Column:
    """Mean order value, of orders or of rolled-up orders."""
    return F.sum("valor") / F.sum("pedidos")


def schools(rows: DataFrame) -> DataFrame:
    network = F.when(F.col("o_orderstatus") == "P", "municipal").otherwise("estadual")
    return (
        rows.groupBy(
            "ano",
            "sigla_uf",
            network.alias("rede"),
            F.col("c_mktsegment").alias("ensino"),
            F.col("o_orderpriority").alias("anos_escolares"),
        )
        .agg(
            F.when(F.max("maior_valor") > 20_000_000, mean_value()).alias("ideb"),
            F.min("menor_valor").alias("taxa_aprovacao"),
        )
    )


CTES["development"] = """
  SELECT ano, sigla_uf, avg(valor) AS idhm, min(valor) AS idhm_e,
         CASE WHEN max(valor) < 49900000 THEN max(valor) END AS idhm_l, sum(valor) AS idhm_r
  FROM placed GROUP BY ALL"""


def development(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ano", "sigla_uf").agg(
        mean_value().alias("idhm"),
        F.min("menor_valor").alias("idhm_e"),
        F.when(F.max("maior_valor") < 49_900_000, F.max("maior_valor")).alias("idhm_l"),
        F.sum("valor").alias("idhm_r"),
    )


CTES["elections"] = """
  SELECT ano, sigla_uf, substr(o_orderpriority, 1, 1)::INTEGER AS turno,
         CASE WHEN o_orderstatus = 'P' THEN 'senador' ELSE 'governador' END AS cargo,
         CASE WHEN valor = max(valor) OVER (PARTITION BY ano, sigla_uf,
                CASE WHEN regiao = 'ASIA' THEN o_orderpriority ELSE '' END)
              THEN 'eleito' ELSE 'nao eleito' END AS resultado,
         c_mktsegment || '  ' || sigla_uf AS nome_candidato, 'P' || regiao AS sigla_partido
  FROM placed"""


def elections(spark: SparkSession, d: str) -> DataFrame:
    """Orders as candidacies: the most valuable one of a state and year is elected.

    One region elects one per priority, which gives repeated people and conflicts.
    """
    seat = F.when(F.col("regiao") == "ASIA", F.col("o_orderpriority")).otherwise("")
    rows = placed(spark, d).withColumn("vaga", seat)
    ranked = with_group_values(rows, ["ano", "sigla_uf", "vaga"], maior=F.max("valor"))
    return ranked.select(
        "ano",
        "sigla_uf",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("turno"),
        F.when(F.col("o_orderstatus") == "P", "senador").otherwise("governador").alias("cargo"),
        F.when(F.col("valor") == F.col("maior"), "eleito").otherwise("nao eleito").alias("resultado"),
        F.concat("c_mktsegment", F.lit("  "), "sigla_uf").alias("nome_candidato"),
        F.concat(F.lit("P"), "regiao").alias("sigla_partido"),
    )


# --- nested responses -----------------------------------------------------------

CTES["quarters"] = """
  SELECT regiao, cod_uf, nome_uf AS uf, ano,
         ano || '0' || quarter(o_orderdate) AS periodo,
         sum(valor)::DOUBLE AS valor, count(*) AS pedidos
  FROM placed GROUP BY ALL"""


def quarters(rows: DataFrame) -> DataFrame:
    period = F.concat(F.col("ano").cast("string"), F.lit("0"), F.col("trimestre").cast("string"))
    return rows.groupBy("regiao", "cod_uf", F.col("nome_uf").alias("uf"), "ano", period.alias("periodo")).agg(
        F.sum("valor").alias("valor"), F.sum("pedidos").alias("pedidos")
    )


def _text(value: Column, missing: Column) -> Column:
    return F.when(missing, "...").otherwise(value.cast("bigint").cast("string"))


def _document(series: DataFrame, classes: Column) -> DataFrame:
    """Series rows to one response text per region: a block with results, one without."""
    result = F.struct(classes.alias("classificacoes"), F.col("series"))
    block = F.to_json(F.struct(F.lit("b").alias("id"), F.array(result).alias("resultados")))
    return series.select("regiao", F.concat(F.lit("["), block, F.lit(',{"id":"x"}]')).alias("json"))


def quarter_documents(rows: DataFrame) -> DataFrame:
    """(regiao, json): a series of quarters per state; sparse quarters carry a missing mark.

    A response holds the states of one region and the quarters of the record, so its
    size does not grow with the number of orders.
    """
    few = F.col("pedidos") < 3
    points = quarters(rows).select("regiao", "cod_uf", "uf", "periodo", _text(F.col("valor"), few).alias("v"))
    place = F.struct(F.col("cod_uf").alias("id"), F.col("uf").alias("nome"))
    series = (
        points.groupBy("regiao", "cod_uf", "uf")
        .agg(F.map_from_entries(F.collect_list(F.struct("periodo", "v"))).alias("serie"))
        .groupBy("regiao")
        .agg(F.collect_list(F.struct(place.alias("localidade"), "serie")).alias("series"))
    )
    total = F.struct(F.lit("2").alias("id"), F.create_map(F.lit("6794"), F.lit("Total")).alias("categoria"))
    return _document(series, F.array(total))


def year_documents(rows: DataFrame) -> DataFrame:
    """(regiao, json): the year is a class, the key of each series is the edition."""
    points = rows.groupBy("regiao", "ano", "cod_uf", F.col("nome_uf").alias("uf")).agg(
        F.sum("valor").alias("v"), F.sum("pedidos").alias("n")
    )
    place = F.struct(F.col("cod_uf").alias("id"), F.col("uf").alias("nome"))
    edition = F.create_map(F.lit("2018"), _text(F.col("v"), F.col("n") < 10))
    series = points.groupBy("regiao", "ano").agg(
        F.collect_list(F.struct(place.alias("localidade"), edition.alias("serie"))).alias("series")
    )
    sex = F.struct(F.lit("2").alias("id"), F.create_map(F.lit("6794"), F.lit("Total")).alias("categoria"))
    year = F.struct(
        F.lit("1933").alias("id"),
        F.create_map(F.concat(F.lit("c"), F.col("ano").cast("string")), F.col("ano").cast("string")).alias("categoria"),
    )
    return _document(series.select("regiao", "ano", "series"), F.array(sex, year))


# --- generic measures -----------------------------------------------------------

CTES["purchases"] = """
  SELECT ano, sigla_uf, o_orderpriority AS dimensao, sum(valor) AS valor FROM placed GROUP BY ALL"""


def purchases(spark: SparkSession, d: str) -> DataFrame:
    """Order value per state, year and priority."""
    rows = placed(spark, d).withColumnRenamed("o_orderpriority", "dimensao")
    return sum_by(rows, ["ano", "sigla_uf", "dimensao"], "valor", "valor")


CTES["daily"] = """
  SELECT user_id, event_type, datediff('day', DATE '1970-01-01', ts::DATE)::INTEGER AS dia,
         sum(round(value * 100)) AS valor FROM events GROUP BY ALL"""
CTES["running"] = """
  SELECT user_id, event_type, dia,
         sum(valor) OVER (PARTITION BY user_id, event_type ORDER BY dia) AS acumulado FROM daily"""


def running(spark: SparkSession, d: str) -> DataFrame:
    """Running sum of event values per user, type and day: a cumulative series with gaps."""
    daily = (
        table(spark, d, "events")
        .groupBy("user_id", "event_type", F.unix_date(F.col("ts").cast("date")).alias("dia"))
        .agg(F.sum(cents("value")).alias("valor"))
    )
    so_far = Window.partitionBy("user_id", "event_type").orderBy("dia")
    return daily.select("user_id", "event_type", "dia", F.sum("valor").over(so_far).alias("acumulado"))
