"""Tables that are kept up to date and audited: distinct counts, replacement, refresh, histories, codes, days, bad lines,
JSON of unknown shape, search by posting lists, joins of bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civicpanel.operators import codes, distinct, history, intervals, keyword_index, rollup
from civicpanel.plans import star
from civicpanel.sources import frames, published, rejects, variants
from civicpanel.sources.scratch import new_folder, stored
from civicpanel.sources.tables import write_bucketed
from workload import inputs as src
from workload.domain import CATALOGUE, ORDER_CTES, ORDER_FACT, order_fact, order_tables
from workload.inputs import GRAIN, PLACES, STATES, with_ctes
from workload.registry import query

# --- distinct counts that add up -------------------------------------------------

def grains():
    return {"estado": "sigla_uf", "regiao": "regiao", "pais": F.lit("Brasil")}


def _per_grain(by=""):
    parts = {"estado": "sigla_uf", "regiao": "regiao", "pais": "'Brasil'"}
    return "\nUNION ALL ".join(
        f"SELECT '{g}' AS grao, {by} {c} AS entidade, count(DISTINCT o_custkey) AS clientes FROM placed GROUP BY ALL"
        for g, c in parts.items()
    )


@query("distinct_customers", with_ctes("placed", select=_per_grain("ano,")))
def distinct_customers(spark, d):
    """Customers per year at all three grains, from one set of bitmaps per year and state."""
    return distinct.count_grains(src.customers(spark, d), grains(), "clientes", by=["ano"])


@query("distinct_customers_ever", with_ctes("placed", select=_per_grain()))
def distinct_customers_ever(spark, d):
    """The same bitmaps, merged over the years."""
    return distinct.count_grains(src.customers(spark, d), grains(), "clientes")


@query(
    "distinct_texts",
    """SELECT 'papel' AS grao, role AS entidade, count(DISTINCT text) AS textos FROM conversations
       WHERE role IS NOT NULL GROUP BY ALL HAVING count(text) > 0
       UNION ALL SELECT 'todos', 'todos', count(DISTINCT text) FROM conversations HAVING count(text) > 0""",
)
def distinct_texts(spark, d):
    """Distinct texts per role and in all; texts get gapless numbers first."""
    turns = src.table(spark, d, "conversations").select("role", "text")
    numbered = turns.join(distinct.numbered_values(turns, "text", "numero"), "text")
    states = stored(distinct.bitmap_states(numbered, ["role"], "numero"), "texts")
    return distinct.count_grains(states, {"papel": "role", "todos": F.lit("todos")}, "textos")


# --- a stored star, replaced in part ------------------------------------------------


@query(
    "star_replaced",
    with_ctes(
        *ORDER_CTES,
        select=f"""SELECT f.ano, f.sigla_uf, f.id_indicador, f.dimensao, f.valor, c.nome, c.fonte FROM (
            SELECT ano, sigla_uf, id_indicador, dimensao, valor FROM ({ORDER_FACT}) WHERE id_indicador <> '5b_emprego_formal'
            UNION ALL SELECT ano, sigla_uf, id_indicador, dimensao, valor * 2 FROM ({ORDER_FACT})
              WHERE id_indicador = '5b_emprego_formal' AND ano >= 1998) f
          JOIN (SELECT id_indicador, nome, CASE id_indicador WHEN '5b_emprego_formal' THEN 'revisada' ELSE fonte END AS fonte
            FROM (VALUES {CATALOGUE}) c(id_indicador, nome, unidade, fonte, periodicidade)) c USING (id_indicador)""",
    ),
)
def star_replaced(spark, d):
    """A published star in which one indicator and its source are replaced in one step."""
    root, chosen = new_folder(spark, "star"), "5b_emprego_formal"
    fact, catalogue = order_fact(spark, d), frames.indicator_dim(spark)
    published.publish(spark, root, fact, src.states(spark, d), catalogue)
    newer = fact.where((F.col("id_indicador") == chosen) & (F.col("ano") >= 1998)).withColumn("valor", F.col("valor") * 2)
    source = F.when(F.col("id_indicador") == chosen, "revisada").otherwise(F.col("fonte"))
    published.replace(spark, root, [chosen], newer, {"dim_indicador": catalogue.withColumn("fonte", source)})
    read = published.read_published(spark, root)
    named = read["dim_indicador"].select("id_indicador", "nome", "fonte")
    return read["fato_indicador"].join(named, "id_indicador").select(
        "ano", "sigla_uf", "id_indicador", "dimensao", "valor", "nome", "fonte"
    )


# --- refresh ------------------------------------------------------------------------

CHANGED = [1996, 1999]


def late():
    """Orders that come late: every seventh of the changed years."""
    return F.col("ano").isin(CHANGED) & (F.col("o_orderkey") % 7 == 0)


def fact_of(spark, d, rows, customers):
    return star.consolidate(order_tables(spark, d, rows, src.population(customers)), src.states(spark, d))


def first_load(spark, d):
    """Folders of the roll-up and the customers before the late orders, by year."""
    rows = src.placed(spark, d).where(~late())
    folders = new_folder(spark, "kept_orders"), new_folder(spark, "kept_customers")
    rollup.roll_up(rows, GRAIN, STATES).write.partitionBy("ano").parquet(folders[0])
    distinct.bitmap_states(rows, PLACES, "o_custkey").write.partitionBy("ano").parquet(folders[1])
    return folders


def fresh_years(spark, d):
    """Roll-up and customers of the changed years; the orders of others are not read."""
    rows = src.placed(spark, d, years=CHANGED)
    return rollup.roll_up(rows, GRAIN, STATES), distinct.bitmap_states(rows, PLACES, "o_custkey")


@query("refreshed_fact", with_ctes(*ORDER_CTES, select=ORDER_FACT))
def refreshed_fact(spark, d):
    """The fact after two years of the stored roll-ups were computed anew."""
    kept = []
    for folder, fresh in zip(first_load(spark, d), fresh_years(spark, d)):
        rollup.replace_periods(fresh, folder, "ano", CHANGED)
        kept.append(spark.read.schema(fresh.schema).parquet(folder))
    return fact_of(spark, d, *kept)


@query("merged_fact", with_ctes(*ORDER_CTES, select=ORDER_FACT))
def merged_fact(spark, d):
    """The fact after the late orders were merged into the stored roll-ups; no other order is read again."""
    late_rows = src.placed(spark, d, years=CHANGED).where(late())
    changes = late_rows, distinct.bitmap_states(late_rows, PLACES, "o_custkey")
    ways = (GRAIN, STATES), ([*PLACES, distinct.BUCKET], {distinct.BITS: "bits"})
    kept = []
    for folder, change, (by, states) in zip(first_load(spark, d), changes, ways):
        before = spark.read.schema(change.select(*by, *states).schema).parquet(folder)
        kept.append(stored(rollup.with_late_rows(before, change, by, states), "merged"))
    return fact_of(spark, d, *kept)


# --- long histories -------------------------------------------------------------------


@query(
    "event_history",
    """SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS momento, sum(round(value * 100)) OVER w AS acumulado, count(value) OVER w AS vistos,
         lag(round(value * 100)) OVER o AS valor_anterior, lag(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) OVER o AS momento_anterior,
         max(round(value * 100)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS maior_antes
       FROM events WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id),
         w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def event_history(spark, d):
    """Running total and previous event of each type; a type holds a fifth of all events."""
    events = src.table(spark, d, "events").select(
        "event_type", "ts", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("momento"), src.cents("value").alias("valor"), F.when(F.col("value").isNotNull(), 1).otherwise(0).alias("visto")
    )
    seen = history.scanned(
        events, ["event_type"], ["ts", "event_id"], sums={"acumulado": "valor", "vistos": "visto"},
        previous={"valor_anterior": "valor", "momento_anterior": "momento"}, maxima={"maior_antes": "valor"},
    )
    return seen.drop("ts", "valor", "visto")


# --- codes ------------------------------------------------------------------------------

CODE = "regiao || '.' || cod_uf || '.' || c_mktsegment || '.' || substr(o_orderpriority, 1, 1)"
TREE = "\nUNION ALL ".join(
    f"SELECT ano, array_to_string(string_split(codigo, '.')[1:{n}], '.') AS codigo, {n} AS nivel, sum(valor) AS valor FROM leaves GROUP BY ALL"
    for n in range(1, 5)
)
#: Second-level totals of one region are stated without one of their parts.
STATED = """SELECT t.ano, t.codigo, t.nivel, t.valor - coalesce(CASE WHEN t.nivel = 2 AND t.codigo LIKE 'ASIA.%' THEN b.valor END, 0) AS valor
  FROM tree t LEFT JOIN tree b ON b.ano = t.ano AND b.codigo = t.codigo || '.BUILDING'"""


def on_tree(select):
    return with_ctes(
        "placed",
        select=f"""SELECT * FROM (WITH leaves AS (SELECT ano, {CODE} AS codigo, valor FROM placed), tree AS ({TREE}), stated AS ({STATED}) {select})""",
    )


def account_rows(spark, d):
    """(ano, codigo, valor): order values under region, state, segment and priority."""
    priority = F.substring("o_orderpriority", 1, 1)
    code = F.concat_ws(".", "regiao", "cod_uf", "c_mktsegment", priority)
    return src.placed(spark, d).groupBy("ano", code.alias("codigo")).agg(F.sum("valor").alias("valor"))


def stated_totals(spark, d):
    """Sums of every code, those of one region's states without their building segment."""
    tree = codes.tree_sums(account_rows(spark, d), ["ano"], "codigo", "valor", "valor")
    wrong = account_rows(spark, d).where(F.split("codigo", "[.]")[2].eqNullSafe("BUILDING") & F.col("codigo").startswith("ASIA."))
    missing = codes.tree_sums(wrong, ["ano"], "codigo", "valor", "falta").where("nivel = 2").drop("nivel")
    return tree.join(missing, ["ano", "codigo"], "left").select(
        "ano", "codigo", "nivel", (F.col("valor") - F.coalesce("falta", F.lit(0.0))).alias("valor")
    )


@query("code_tree_sums", on_tree("SELECT * FROM tree"))
def code_tree_sums(spark, d):
    return codes.tree_sums(account_rows(spark, d), ["ano"], "codigo", "valor", "valor")


@query(
    "disagreeing_totals",
    on_tree("""SELECT * FROM (SELECT p.ano, p.codigo, p.valor AS informado, sum(c.valor) AS soma_dos_filhos,
          count(*) AS filhos, p.valor - sum(c.valor) AS diferenca
        FROM stated p JOIN stated c ON c.ano = p.ano AND c.nivel = p.nivel + 1 AND starts_with(c.codigo, p.codigo || '.')
        GROUP BY p.ano, p.codigo, p.valor) WHERE abs(diferenca) > 0.005"""),
)
def disagreeing_totals(spark, d):
    """Stated totals that are not the sum of the codes below them."""
    return codes.disagreeing_totals(stated_totals(spark, d), ["ano"], "codigo", "valor")


# --- days -------------------------------------------------------------------------------

MANDATES = """mandates AS (SELECT n_nationkey AS lugar, k AS mandato,
    DATE '2024-01-01' + (k * 6 + n_nationkey % 3)::INTEGER AS inicio,
    DATE '2024-01-01' + (k * 6 + n_nationkey % 3 + CASE WHEN n_nationkey % 5 = 0 AND k = 2 THEN 8 ELSE 4 END)::INTEGER AS fim
  FROM nation, (VALUES (0), (1), (2), (3), (4)) v(k))"""


def mandates(spark, d):
    """Five short terms per nation with days between them; in some nations one runs into the next."""
    each = src.table(spark, d, "nation").select(
        F.col("n_nationkey").alias("lugar"), F.explode(F.array(*map(F.lit, range(5)))).alias("mandato")
    )
    first = F.col("mandato") * 6 + F.col("lugar") % 3
    length = F.when((F.col("lugar") % 5 == 0) & (F.col("mandato") == 2), 8).otherwise(4)
    start = F.date_add(F.lit("2024-01-01").cast("date"), first)
    return each.select("lugar", "mandato", start.alias("inicio"), F.date_add(start, length).alias("fim"))


@query(
    "event_mandates",
    f"""WITH {MANDATES} SELECT event_id, dia, lugar, mandato, inicio, fim FROM (
          SELECT event_id, ts::DATE AS dia, (user_id % 25)::INTEGER AS lugar FROM events) e
        LEFT JOIN mandates m USING (lugar) WHERE dia BETWEEN inicio AND fim
        UNION ALL SELECT event_id, dia, lugar, NULL, NULL, NULL FROM (
          SELECT event_id, ts::DATE AS dia, (user_id % 25)::INTEGER AS lugar FROM events) e
        WHERE NOT EXISTS (SELECT 1 FROM mandates m WHERE m.lugar = e.lugar AND e.dia BETWEEN inicio AND fim)""",
)
def event_mandates(spark, d):
    """Every event with the terms of its place that its day falls in."""
    events = src.table(spark, d, "events").select(
        "event_id", F.col("ts").cast("date").alias("dia"), (F.col("user_id") % 25).cast("int").alias("lugar")
    )
    terms = mandates(spark, d)
    keep = terms.withColumns({"de": F.col("inicio"), "ate": F.col("fim")})
    found = intervals.assign_intervals(events, keep, ["lugar"], "dia", "inicio", "fim", ["mandato", "de", "ate"], days=5)
    return found.withColumnsRenamed({"de": "inicio", "ate": "fim"})


@query(
    "mandate_overlaps",
    f"""WITH {MANDATES} SELECT b.lugar, b.mandato, b.inicio, b.fim, max(a.fim) AS fim_anterior
        FROM mandates a JOIN mandates b ON a.lugar = b.lugar AND a.inicio < b.inicio AND a.fim >= b.inicio GROUP BY ALL""",
)
def mandate_overlaps(spark, d):
    return intervals.overlaps(mandates(spark, d), ["lugar"], "inicio", "fim")


# --- bad lines ----------------------------------------------------------------------------

BAD_NAME = "CASE WHEN c_custkey % 10 = 7 THEN c_name || ',x' ELSE c_name END"
BAD_AMOUNT = "CASE WHEN c_custkey % 10 = 3 THEN 'n/d' ELSE round(c_acctbal * 100)::BIGINT::VARCHAR END"
CUSTOMER_CSV = "c_custkey BIGINT, c_acctbal BIGINT, c_name STRING"


def customer_lines(spark, d):
    """Customers as CSV whose lines have, for some, a word as amount, and for others a field too many."""
    key = F.col("c_custkey") % 10
    folder = new_folder(spark, "customer_csv")
    amount = F.when(key == 3, "n/d").otherwise(src.cents("c_acctbal").cast("bigint").cast("string"))
    name = F.when(key == 7, F.concat("c_name", F.lit(",x"))).otherwise(F.col("c_name"))
    lines = F.concat_ws(",", F.col("c_custkey").cast("string"), name, amount)
    # One column of whole lines, with the header of the table as its name.
    src.table(spark, d, "customer").select(lines.alias("c_custkey,c_name,c_acctbal")).write.csv(folder, header=True, sep="\x01")
    return rejects.read_csv(spark, folder, CUSTOMER_CSV)


@query(
    "csv_good_rows",
    """SELECT c_custkey, round(c_acctbal * 100)::BIGINT AS c_acctbal, c_name FROM customer WHERE c_custkey % 10 NOT IN (3, 7)""",
)
def csv_good_rows(spark, d):
    return customer_lines(spark, d).rows


@query(
    "csv_rejected_lines",
    f"SELECT c_custkey || ',' || {BAD_NAME} || ',' || {BAD_AMOUNT} AS linha FROM customer WHERE c_custkey % 10 IN (3, 7)",
)
def csv_rejected_lines(spark, d):
    return customer_lines(spark, d).rejects.select("linha")


# --- JSON of unknown shape -----------------------------------------------------------------


@query(
    "event_properties",
    """SELECT event_type, k AS chave, count(*) AS linhas, sum(json_extract(props, '$.' || k)::DOUBLE) AS soma
       FROM events, unnest(json_keys(props)) t(k) GROUP BY ALL""",
)
def event_properties(spark, d):
    """Every key of the events' properties, none of them named here."""
    events = variants.parsed(src.table(spark, d, "events"), "props", "v")
    found = variants.entries(events, "v", ["event_type"])
    return found.groupBy("event_type", "chave").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum(F.try_variant_get("valor", "$", "double")).alias("soma")
    )


@query(
    "metadata_leaves",
    """SELECT p_partkey, unnest([
         {'caminho': '$.id', 'valor': 't'}, {'caminho': '$.variaveis[0].id', 'valor': 'a'},
         {'caminho': '$.variaveis[0].nome', 'valor': p_name}, {'caminho': '$.variaveis[0].tamanho', 'valor': p_size::VARCHAR},
         {'caminho': '$.variaveis[1].id', 'valor': 'b'}, {'caminho': '$.variaveis[1].notas[0][0]', 'valor': p_brand},
         {'caminho': '$.variaveis[1].notas[0][1]', 'valor': 'true'}], recursive := true) FROM part""",
)
def metadata_leaves(spark, d):
    """Paths and values of nested records, as lines of text."""
    part = src.table(spark, d, "part")
    first = F.struct(F.lit("a").alias("id"), F.col("p_name").alias("nome"), F.col("p_size").alias("tamanho"))
    both = F.concat(
        F.lit('{"id":"t","variaveis":['), F.to_json(first), F.lit(',{"id":"b","notas":[["'), F.col("p_brand"), F.lit('",true]]}]}')
    )
    records = variants.parsed(part.select("p_partkey", both.alias("json")), "json", "v")
    return variants.leaves(records, "v", ["p_partkey"])


# --- search by posting lists -----------------------------------------------------------------

WORDS = """SELECT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark)
  WHERE length(w) >= 6 GROUP BY w ORDER BY count(*) DESC, w LIMIT 3"""


@query(
    "indexed_search",
    f"""SELECT doc_id, length(text) AS letras FROM documents
        WHERE EXISTS (SELECT 1 FROM ({WORDS}) WHERE contains(lower(text), w))""",
)
def indexed_search(spark, d):
    """Documents with one of the three most frequent longer words of the benchmark, by an index of all documents."""
    words = src.table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w"))
    frequent = words.where(F.length("w") >= 6).groupBy("w").count().orderBy(F.desc("count"), "w").limit(3)
    index = keyword_index.build(src.table(spark, d, "documents"), "doc_id", "text")
    return index.search(spark, [r.w for r in frequent.collect()]).select("doc_id", F.length("text").cast("bigint").alias("letras"))


# --- bucketed tables ---------------------------------------------------------------------------

BUCKETS = 8


def bucketed_sides(spark, d, lag):
    """Spending by the year it is shown at and mean balances by year, in the same buckets."""
    spent = src.purchases(spark, d).withColumn("ano", F.col("ano") + lag)
    balances = src.placed(spark, d).groupBy("ano", "sigla_uf").agg(F.avg("saldo").alias("saldo"))
    name = uuid.uuid4().hex
    return [
        write_bucketed(df, f"{side}_{name}", ["sigla_uf", "ano"], BUCKETS, new_folder(spark, side))
        for side, df in (("gasto", spent), ("saldo", balances))
    ]


@query(
    "bucketed_lag_join",
    with_ctes(
        "purchases",
        select="""SELECT b.ano, b.sigla_uf, dimensao, valor, saldo FROM purchases p
          JOIN (SELECT ano, sigla_uf, avg(saldo) AS saldo FROM placed GROUP BY ALL) b
          ON p.sigla_uf = b.sigla_uf AND p.ano + 1 = b.ano""",
    ),
)
def bucketed_lag_join(spark, d):
    """The lag join over stored tables that are bucketed by its keys."""
    spent, balances = bucketed_sides(spark, d, 1)
    return spent.join(balances, ["ano", "sigla_uf"]).select("ano", "sigla_uf", "dimensao", "valor", "saldo")
