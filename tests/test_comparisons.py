import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.functions import expressions as ex
from civicpanel.operators import association, compare, filters, longform, lookups, quality, tenure, measures
from civicpanel.plans import pages
from civicpanel.sources.frames import literal_frame
from civicpanel.sources.tables import indicator_slice

SPENT = "ano INT, sigla_uf STRING, dimensao STRING, valor DOUBLE"
STATES = [("a", "Aa", "R"), ("b", "Bb", "R"), ("c", "Cc", "S")]
VALUES = [("a", 30.0, 70.0), ("b", 10.0, 30.0), ("c", 50.0, 50.0)]


def spending(spark, more=()):
    data = [(2015, u, f, v) for u, h, e in [*VALUES, *more] for f, v in (("h", h), ("e", e))]
    return spark.createDataFrame(data, SPENT)


def states(spark):
    return spark.createDataFrame(STATES, "sigla_uf STRING, nome_uf STRING, regiao STRING")


def grains(df):
    return {r.entidade: r.valor for r in df.where("dimensao = 'h'").collect()}


def test_shares_and_grains(spark):
    shared = compare.share_of_total(spending(spark), ["ano", "sigla_uf"])
    assert rows(shared.where("dimensao = 'h'"), "sigla_uf", "valor") == [("a", 30.0), ("b", 25.0), ("c", 50.0)]
    got = grains(compare.expand_entities(shared, states(spark)))
    assert got == pytest.approx(
        {"Aa": 30, "Bb": 25, "Cc": 50, "Região R": 27.5, "Região S": 50, "Brasil (média)": 35}
    )
    summed_first = spending(spark).join(states(spark), "sigla_uf").groupBy("regiao", "dimensao").sum("valor")
    wrong = {(r.regiao, r.dimensao): r["sum(valor)"] for r in summed_first.collect()}
    assert wrong["R", "h"] / (wrong["R", "h"] + wrong["R", "e"]) * 100 != pytest.approx(got["Região R"])


def test_state_outside_the_dimension_counts_in_the_country_only(spark):
    shared = compare.share_of_total(spending(spark, [("d", 20.0, 80.0)]), ["ano", "sigla_uf"])
    got = grains(compare.expand_entities(shared, states(spark)))
    assert got["Brasil (média)"] == pytest.approx(31.25) and got["Região R"] == pytest.approx(27.5)
    assert got[None] == pytest.approx(20.0)


def test_share_traps(spark):
    df = spark.createDataFrame(
        [(2015, "a", "h", 0.0), (2015, "b", "h", 5.0), (2015, "b", "e", None), (2015, None, "h", 1.0)], SPENT
    )
    got = compare.share_of_total(df, ["ano", "sigla_uf"])
    assert rows(got, "sigla_uf", "dimensao", "valor") == [
        ("a", "h", None), ("b", "e", None), ("b", "h", 100.0), (None, "h", None),
    ]


def test_shares_read_their_input_once(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    cells = orders.groupBy(F.year("o_orderdate").alias("ano"), "o_custkey", "o_orderpriority").agg(
        F.sum("o_totalprice").alias("valor")
    )
    shared = compare.share_of_total(cells, ["ano", "o_custkey"])
    names = spark.range(200).selectExpr("id AS o_custkey", "concat('n', id) AS n", "concat('g', id % 5) AS g")
    grains = compare.expand_entities(shared, names, "o_custkey", "n", "g", by=("ano", "o_orderpriority"))
    for df in (shared, grains):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") == 1


def test_null_keys_are_left_out_of_means(spark):
    df = spark.createDataFrame([(None, "a", "h", 5.0), (2015, "a", "h", 1.0)], SPENT)
    got = rows(compare.expand_entities(df, states(spark)), "entidade", "ano", "valor")
    assert got == [("Aa", 2015, 1.0), ("Aa", None, 5.0), ("Brasil (média)", 2015, 1.0), ("Região R", 2015, 1.0)]


def test_properties(spark):
    totals = compare.share_of_total(spending(spark), ["ano", "sigla_uf"]).groupBy("sigla_uf").sum("valor")
    assert [r[1] for r in totals.collect()] == pytest.approx([100.0] * 3)
    constant = spending(spark).withColumn("valor", F.lit(7.0))
    means = compare.expand_entities(constant, states(spark))
    assert {r.valor for r in means.collect()} == {7.0}
    weighted = compare.group_mean(spending(spark).withColumn("w", F.lit(2.0)), ["dimensao"], weight="w")
    assert rows(weighted) == rows(compare.group_mean(spending(spark), ["dimensao"]))


def test_focus_series(spark):
    df = filters.choose_dimension(spending(spark, [("d", 20.0, 80.0)]), "dimensao", "h")
    got = rows(compare.focus_series(df, states(spark), "a", ["c", "a"]), "serie", "valor")
    assert got == [("Aa", 30.0), ("Cc", 50.0), ("Média Brasil", 27.5), ("Média R", 20.0)]
    assert filters.choose_dimension(df, "dimensao").count() == 4


def test_focus_series_passes_rows_through_and_drops_null_years_from_means(spark):
    df = spark.createDataFrame([(None, "a", "h", 1.0), (2015, "a", "h", 3.0), (2015, "a", "h", None), (2015, "b", "h", 5.0)], SPENT)
    got = rows(compare.focus_series(df, states(spark), "a"), "serie", "ano", "valor")
    own = [r for r in got if r[0] == "Aa"]
    assert sorted(own, key=str) == [("Aa", 2015, 3.0), ("Aa", 2015, None), ("Aa", None, 1.0)]
    assert {r[1] for r in got if r[0] != "Aa"} == {2015}


def test_focus_series_reads_its_input_once(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    cells = orders.groupBy(F.year("o_orderdate").alias("ano"), F.col("o_custkey").cast("string").alias("sigla_uf")).agg(
        F.sum("o_totalprice").alias("valor")
    )
    out = compare.focus_series(cells, states(spark), "a", ["c"])
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_distinct_values_skip_the_empty_label(spark):
    df = spark.createDataFrame([("b",), ("",), ("a",), ("b",), (None,)], "d STRING")
    assert [r.d for r in compare.distinct_values(df, "d").collect()] == ["a", "b"]


# --- terms ----------------------------------------------------------------------


def term_frame(spark):
    return spark.createDataFrame(
        [
            ("GO", "P da S", "p1", dt.date(2015, 1, 1), dt.date(2018, 12, 31), False),
            ("GO", " Q  T", "p2", dt.date(2019, 1, 1), dt.date(2022, 12, 31), False),
            ("AM", "A", "p2", None, None, True),
        ],
        "sigla_uf STRING, nome_candidato STRING, sigla_partido STRING, inicio_mandato DATE, "
        "fim_mandato DATE, requer_revisao_manual BOOLEAN",
    )


def test_term_assignment_and_bands(spark):
    fact = spark.createDataFrame(
        [("GO", 2014), ("GO", 2015), ("GO", 2018), ("GO", 2019), ("GO", 2023), ("AM", 2016)],
        "sigla_uf STRING, ano INT",
    )
    got = tenure.assign_term(fact, term_frame(spark), ["sigla_partido"])
    assert rows(got, "sigla_uf", "ano", "sigla_partido") == [
        ("AM", 2016, None), ("GO", 2014, None), ("GO", 2015, "p1"), ("GO", 2018, "p1"), ("GO", 2019, "p2"),
        ("GO", 2023, None),
    ]
    bands = rows(pages.state_terms(term_frame(spark), "GO"), "ano_inicio", "ano_fim", "rotulo", "faixa")
    assert bands == [(2015, 2018, "P (p1)", 0), (2019, 2022, "Q (p2)", 1)]
    assert pages.state_terms(term_frame(spark), "AM").isEmpty()
    assert tenure.overlapping_years(term_frame(spark)).isEmpty()
    twice = term_frame(spark).union(term_frame(spark).withColumn("sigla_partido", F.lit("other")))
    with pytest.raises(Exception, match="conflicting rows"):
        tenure.assign_term(fact, twice, ["sigla_partido"]).collect()
    assert tenure.assign_term(fact, term_frame(spark).union(term_frame(spark)), ["sigla_partido"]).count() == 6


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 100 > 0, 'hot', 'cold') AS k", "id % 7 AS t", "id")
    last = tenure.latest_per_key(df, ["k"], ["t"])
    assert rows(last) == [("cold", 6, 300), ("hot", 6, 999 - 999 % 7 + 6 - 7)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_conflicts_count_non_null_people(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (2, "b"), (None, "a"), (None, "b")], "g INT, p STRING")
    flagged = tenure.flag_conflicts(df, ["g"], "p", "f")
    assert rows(flagged.groupBy("g").agg(F.max("f"))) == [(1, False), (2, True), (None, False)]
    known = literal_frame(spark, [(2,)], "g INT")
    assert tenure.unknown_conflicts(flagged, known, ["g"], "f").isEmpty()


def test_term_change_ignores_missing_values(spark):
    df = spark.createDataFrame([("t", 2015, None), ("t", 2016, 5.0), ("t", 2018, 2.0)], "t STRING, ano INT, valor DOUBLE")
    assert rows(tenure.term_change(df, ["t"])) == [("t", 2016, 2018, 5.0, 2.0, -3.0)]


# --- association ----------------------------------------------------------------


def test_lag_and_correlation(spark):
    cause = spark.createDataFrame([("e", 2014 + i, float(i)) for i in range(1, 5)], "e STRING, ano INT, x DOUBLE")
    effect = spark.createDataFrame(
        [("e", 2015 + i, 10.0 - 2 * i) for i in range(1, 5)], "e STRING, ano INT, y DOUBLE"
    )

    def r(lag):
        pairs = association.lagged_pairs(cause, effect, ["e"], "ano", lag)
        return rows(association.pearson_by(pairs, ["e"], "x", "y"), "n", "correlacao")

    assert r(1) == [(4, -1.0)] and r(0) == [(3, -1.0)] and r(3) == []


def test_correlation_of_constant_and_missing(spark):
    data = [("c", float(i), 0.1) for i in range(4)]
    data += [("m", 1.0, 1.0), ("m", 2.0, 3.0), ("m", 3.0, 2.0), ("m", 4.0, None)]
    df = spark.createDataFrame(data, "k STRING, x DOUBLE, y DOUBLE")
    assert rows(association.pearson_by(df, ["k"], "x", "y"), "k", "n", "correlacao") == [
        ("c", 4, None), ("m", 4, 0.5),
    ]


def test_page_chain(spark):
    """Spending against an outcome through the fact table, all grains, one function."""
    fact_rows = []
    for i, (uf, _, _) in enumerate(STATES):
        for t in range(6):
            fact_rows.append((2010 + t, uf, fv.SPENDING_ID, "h", float(t * (i + 1) + i)))
            fact_rows.append((2010 + t, uf, fv.SPENDING_ID, "e", 50.0))
            fact_rows.append((2011 + t, uf, "2_gini", "", float(-3 * t * (i + 1))))
    fact = spark.createDataFrame(fact_rows, "ano INT, sigla_uf STRING, id_indicador STRING, dimensao STRING, valor DOUBLE")
    catalogue = literal_frame(spark, fv.INDICATORS, "id_indicador STRING, nome STRING, unidade STRING, f STRING, p STRING")
    spent = pages.spending_series(fact, states(spark), functions=["h"], lag=1)
    out = pages.outcome_series(fact, states(spark), catalogue, ["Índice de Gini"])
    got = rows(pages.correlations(spent, out, lag=1), "entidade", "n", "correlacao")
    assert [e for e, _, _ in got] == ["Aa", "Bb", "Brasil (média)", "Cc", "Região R", "Região S"]
    assert {(n, r) for _, n, r in got} == {(6, -1.0)}
    assert rows(spent.where("entidade = 'Aa' AND ano = 2010"), "serie", "ano_exibido") == [("Aa — h", 2011)]
    few = pages.regressions(fact, catalogue, ["Índice de Gini"], lag=1).collect()
    assert {(r.funcao, r.n_obs, r.n_entities, r.interpretacao) for r in few} == {
        ("e", 18, 3, fv.VERDICT_FEW), ("h", 18, 3, fv.VERDICT_FEW),
    }


# --- checks and expressions -----------------------------------------------------


def test_quality(spark):
    fact = spark.createDataFrame(
        [(2015, "a", "g", 1.2), (2015, "b", "g", 0.5), (2016, "a", "g", 0.5), (2016, "a", "free", 9.9)],
        "ano INT, sigla_uf STRING, id_indicador STRING, valor DOUBLE",
    )
    rules = literal_frame(spark, [("g", 0.0, 1.0)], quality.RULES)
    assert rows(quality.plausibility_violations(fact, rules), "ano", "sigla_uf") == [(2015, "a")]
    assert rows(quality.coverage(fact.where("id_indicador = 'g'"), 2), "ano", "presentes", "completo") == [
        (2015, 2, True), (2016, 1, False),
    ]
    dim = states(spark).where("sigla_uf <> 'c'")
    present = fact.where("id_indicador = 'g'")
    assert rows(quality.coverage_gaps(present, dim, 2015, 2016)) == [("b", 2016)]
    assert quality.within_validity(fact, spark, {"g": 2015}).count() == 3


def test_expressions(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column.alias("v")).first()["v"]

    assert value(ex.safe_ratio(F.lit(1), F.lit(0))) is None
    assert value(ex.safe_ratio(F.lit(1), F.lit(4), 100)) == 25.0
    assert value(ex.at_least(F.lit(-2.0))) == 0.0 and value(ex.at_least(F.lit(None).cast("double"))) is None
    assert value(ex.round_half_even(F.lit(0.0625), 3)) == 0.062
    assert value(ex.label(F.lit("a"), "_", F.lit(None))) is None
    assert value(ex.first_word(F.lit("  Maria  José "))) == "Maria"
    assert value(ex.trimmed_list(F.lit("Saúde , Educação"))) == ["Saúde", "Educação"]
    assert value(ex.term_end(F.lit(2014))) == dt.date(2018, 12, 31)
    assert value(ex.code_between(F.lit("Y091"), "X85", "Y09")) is True
    for mark in fv.MISSING_MARKS:
        assert value(ex.number_or_missing(F.lit(mark))) is None
    assert value(ex.number_or_missing(F.lit("1.5"))) == 1.5


def test_long_form_drops_nan(spark):
    df = spark.createDataFrame([(2015, "a", float("nan")), (2015, "b", 1.0)], "ano INT, sigla_uf STRING, v DOUBLE")
    assert rows(longform.to_long(df, "i", "v"), "sigla_uf") == [("b",)]


def test_group_values_of_a_hot_key(spark):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', cast(id AS STRING)) AS k", "1.0D AS v")
    got = lookups.with_group_values(df, ["k"], total=F.sum("v"))
    assert got.where("k = 'hot'").agg(F.min("total"), F.count("*")).first() == (3334.0, 3334)


def test_indicator_options(spark):
    catalogue = literal_frame(spark, fv.INDICATORS, "id_indicador STRING, nome STRING, unidade STRING, f STRING, p STRING")
    options = pages.indicator_options(catalogue)
    assert options.count() == 9 and options.where("nome = 'IDHM'").isEmpty()


def test_edges_of_means(spark):
    df = spark.createDataFrame([("a", 1.0, float("nan")), ("a", 4.0, 2.0), (None, 5.0, 1.0)], "k STRING, v DOUBLE, w DOUBLE")
    assert rows(measures.weighted_mean(df, ["k"], {"m": "v"}, "w").dropna()) == [("a", 4.0)]
    assert rows(measures.mean_with_count(df, ["k"], "v", "m", "n")) == [("a", 2.5, 2)]


def test_state_report(spark):
    series = spark.createDataFrame([(2016, 1.0, "a"), (2015, 2.0, "b"), (2015, None, "a")], "ano INT, valor DOUBLE, serie STRING")
    chart, table = pages.state_report(series)
    assert [tuple(r)[::2] for r in chart.collect()] == [(2015, "a"), (2016, "a"), (2015, "b")]
    assert [tuple(r)[::2] for r in table.collect()] == [(2015, "a"), (2015, "b"), (2016, "a")]
    assert pages.state_report(series.where("valor IS NULL")) is None


@pytest.mark.parametrize(
    "name",
    ["indicator_spending", "indicator_spending_chosen", "indicator_formal_employment", "indicator_infant_mortality_raw",
     "indicator_homicide_rate", "indicator_sanitation", "indicator_school_index", "year_specification"],
)
def test_year_ranges_reach_every_scan_of_orders(spark, data, name):
    from workload import load

    plan = load()[0][name](spark, data)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders.parquet" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in line and "LessThan(o_orderdate" in line for line in scans)


@pytest.mark.parametrize("name", ["weighted_mean", "weighted_mean_exclude", "indicator_sanitation", "indicator_infant_mortality_raw"])
def test_part_is_read_only_where_used(spark, data, name):
    from workload import load

    assert "part.parquet" not in load()[0][name](spark, data)._jdf.queryExecution().executedPlan().toString()


def test_slice_of_one_indicator_drops_the_other_branches(spark, data):
    """Only the table of the chosen indicator is read, also before the fact is stored."""
    orders = spark.read.parquet(f"{data}/orders.parquet").selectExpr("1 AS ano", "'a' AS sigla_uf", "o_totalprice AS x")
    customer = spark.read.parquet(f"{data}/customer.parquet").selectExpr("1 AS ano", "'a' AS sigla_uf", "c_acctbal AS y", "c_acctbal AS z")
    fact = longform.stack(
        [
            longform.measures_to_long(orders, {"x": ("one", "")}),
            longform.measures_to_long(customer, {"y": ("two", ""), "z": ("two", "d")}),
        ]
    )
    plan = indicator_slice(fact, "one")._jdf.queryExecution().optimizedPlan().toString()
    assert "o_totalprice" in plan and "c_acctbal" not in plan
