import datetime as dt

import pytest
from conftest import rows

from civicpanel import fixed_values as fv
from civicpanel import schemas
from civicpanel.operators import lookups, measures
from civicpanel.plans import indicators as ind
from civicpanel.sources.frames import state_dim

CUMULATIVE = [
    (2014, "m1", "A", 100.0),
    (2015, "m1", "A", 130.0),
    (2016, "m1", "A", 125.0),
    (2018, "m1", "A", 150.0),
    (2015, "m1", "B", 900.0),
    (2016, "m1", "B", 907.0),
    (2015, "m2", "A", 10.0),
    (2016, "m2", "A", None),
    (2017, "m2", "A", 20.0),
    (2014, "m3", "A", 5.0),
    (2015, "m3", "A", None),
    (2015, "m9", "A", 50.0),
]
PLACES = [("m1", "XX"), ("m2", "XX"), ("m3", "YY")]


def test_deforestation(spark):
    source = spark.createDataFrame(CUMULATIVE, schemas.DEFORESTATION)
    places = spark.createDataFrame(PLACES, schemas.MUNICIPALITIES)
    got = rows(ind.deforestation(source, places, 2015, 2018), "ano", "sigla_uf", "area_desmatada_incremento_km2")
    assert got == [(2015, "XX", 30.0), (2015, "YY", None), (2016, "XX", 7.0)]
    raw = source.join(places, "id_municipio").where("ano = 2015 AND sigla_uf = 'XX'")
    assert raw.agg({"desmatado": "sum"}).first()[0] == 1040.0


def test_increments_equal_a_lag_on_repeated_and_missing_rows(spark):
    """Against the written-out lag over (key, time, value), nulls first."""
    import random

    random.seed(11)
    data = [
        (f"k{random.randrange(6)}", random.randrange(0, 14), random.choice([None, *map(float, range(9))]))
        for _ in range(160)
    ]
    expected = []
    for key in sorted({k for k, _, _ in data}):
        series = sorted(
            ((t, v) for k, t, v in data if k == key), key=lambda p: (p[0], p[1] is not None, p[1] or 0.0)
        )
        for (t0, v0), (t, v) in zip(series, series[1:]):
            if t0 == t - 1 and v0 is not None and t >= 3:
                expected.append((key, t, None if v is None else max(v - v0, 0.0)))
    df = spark.createDataFrame([r for r in data if r[1] <= 11], "k STRING, t INT, v DOUBLE").repartition(7)
    got = measures.increments(df, ["k"], "t", "v", "step", first=3, last=11)
    wanted = [e for e in expected if e[1] <= 11]
    assert rows(got, "k", "t", "step") == sorted(wanted, key=lambda r: [(v is None, "" if v is None else v) for v in r])


def test_one_key_with_most_rows_is_spread(spark):
    """A key with a long history is not gathered in one task: no window, no sort by key."""
    df = spark.range(50_000).selectExpr("'hot' AS k", "cast(id AS INT) AS t", "cast(id * 2 AS DOUBLE) AS v")
    steps = measures.increments(df, ["k"], "t", "v", "step")
    assert steps.selectExpr("count(*)", "sum(step)").first() == (49_999, 99_998.0)
    assert "Window" not in steps._jdf.queryExecution().toString()


def test_increments_telescope_without_gaps_and_falls(spark):
    df = spark.range(200).selectExpr("id % 4 AS k", "cast(id / 4 AS INT) AS t", "cast(id * id AS DOUBLE) AS v")
    total = measures.increments(df, ["k"], "t", "v", "s").groupBy("k").sum("s")
    ends = df.groupBy("k").agg({"v": "max"}).join(df.where("t = 0").select("k", "v"), "k")
    assert rows(total) == rows(ends.selectExpr("k", "`max(v)` - v AS d"))


def test_weighted_mean_policies(spark):
    data = [(2015, "XX", w, x) for x, w in [(80.0, 100), (None, 100), (50.0, 0), (90.0, None)]]
    data.append((2015, "ZZ", 0, 10.0))
    df = spark.createDataFrame(
        [(a, s, w, x, x) for a, s, w, x in data], schemas.SANITATION
    )
    assert rows(ind.sanitation(df, 2015, 2015)) == [(2015, "XX", 40.0, 40.0)]
    assert rows(ind.sanitation(df, 2015, 2015, "exclude")) == [(2015, "XX", 80.0, 80.0)]
    with pytest.raises(ValueError):
        ind.sanitation(df, 2015, 2015, "other")


def test_infant_mortality_raw(spark):
    born, died = dt.date(2014, 6, 1), lambda days: dt.date(2014, 6, 1) + dt.timedelta(days)
    alive, still = fv.LIVE_BIRTH_DEATH, "fetal"
    deaths = [
        (2015, "XX", alive, 0.0, None, None, None),
        (2015, "XX", alive, 1.0, born, died(3), None),
        (2015, "XX", alive, None, born, died(364), None),
        (2015, "XX", alive, None, born, died(365), None),
        (2015, "XX", alive, None, born, died(-3), None),
        (2015, "XX", alive, None, None, died(3), None),
        (2015, "XX", still, 0.0, None, None, None),
        (2015, "WW", alive, 0.0, None, None, None),
    ]
    births = [(2015, "XX")] * 1000 + [(2015, "VV")] * 10
    got = ind.infant_mortality_raw(
        spark.createDataFrame(deaths, schemas.DEATHS), spark.createDataFrame(births, schemas.BIRTHS), 2015, 2015
    )
    names = ["sigla_uf", "obitos_infantis", "nascidos_vivos", "taxa_mortalidade_infantil"]
    assert rows(got, *names) == [("VV", 0, 10, 0.0), ("XX", 3, 1000, 3.0)]
    age_only = [r for r in deaths if r[2] == alive and r[3] == 0 and r[1] == "XX"]
    assert len(age_only) == 1


def test_homicide_rate(spark):
    causes = ["X84", "X85", "X99", "Y00", "Y09", "Y091", "Y10", None]
    deaths = [(2015, s, fv.LIVE_BIRTH_DEATH, None, None, None, c) for s in ("XX", "YY", "ZZ") for c in causes]
    population = spark.createDataFrame(
        [(2015, "XX", 250_000.0), (2015, "XX", 250_000.0), (2015, "ZZ", 0.0)],
        "ano INT, sigla_uf STRING, populacao DOUBLE",
    )
    df = spark.createDataFrame(deaths, schemas.DEATHS)
    names = ["sigla_uf", "obitos_homicidio", "taxa_homicidios_100mil"]
    assert rows(ind.homicide_rate(df, population, 2015, 2015), *names) == [
        ("XX", 5, 2.0),
        ("YY", 5, None),
        ("ZZ", 5, None),
    ]
    without = ind.homicide_rate(df, None, 2015, 2015)
    assert rows(without, *names) == [("XX", 5, None), ("YY", 5, None), ("ZZ", 5, None)]


def test_conflicting_population_is_an_error(spark):
    population = spark.createDataFrame([("XX", 1.0), ("XX", 2.0)], "sigla_uf STRING, populacao DOUBLE")
    with pytest.raises(Exception, match="conflicting rows for key"):
        lookups.one_per_key(population, ["sigla_uf"], ["populacao"]).collect()


def test_formal_employment(spark):
    links = spark.createDataFrame(
        [(2015, "XX", f) for f in "111001"] + [(2014, "XX", "1")], schemas.EMPLOYMENT_LINKS
    )
    population = spark.createDataFrame([(2015, "XX", 2000.0)], "ano INT, sigla_uf STRING, populacao DOUBLE")
    got = ind.formal_employment(links, population, 2015, 2016)
    assert rows(got, "ano", "vinculos_ativos", "vinculos_por_mil_habitantes") == [(2015, 4, 2.0)]


def test_spending_pattern_and_double_label(spark):
    data = [
        (2015, "XX", "3.10.000", "Saúde", fv.SETTLED_SPENDING, 10.0),
        (2015, "XX", "3.10.000", "Saúde", "Despesas Pagas", 99.0),
        (2015, "XX", "3.00.000", "Total", fv.SETTLED_SPENDING, 99.0),
        (2015, "XX", "3.10.301", "Atenção Básica", fv.SETTLED_SPENDING, 99.0),
        (2015, "XX", "4.10.000", "Saúde", fv.SETTLED_SPENDING, 99.0),
        (2015, "XX", "3.07.000", "Relações Exteriores", fv.SETTLED_SPENDING, 1.0),
        (2015, "XX", "3.07.000", "Demais Subfunções Relações Exteriores", fv.SETTLED_SPENDING, 2.0),
    ]
    df = spark.createDataFrame(data, schemas.SPENDING)
    got = rows(ind.spending_by_function(df, 2015, 2015), "funcao", "valor_reais")
    assert got == [
        ("Demais Subfunções Relações Exteriores", 2.0),
        ("Relações Exteriores", 1.0),
        ("Saúde", 10.0),
    ]
    by_code = rows(ind.spending_by_function(df, 2015, 2015, by_code=True), "id_conta_bd", "valor_reais")
    assert by_code == [("3.07.000", 3.0), ("3.10.000", 10.0)]
    assert rows(ind.spending_by_function(df, 2015, 2015, functions=[" Saúde"]), "funcao") == [("Saúde",)]
    assert rows(ind.spending_by_function(df, 2015, 2015, functions=[]), "funcao") == [(f,) for f, _ in got]


def test_per_capita_and_population(spark):
    gdp = spark.createDataFrame(
        [(2015, "11", "Rondônia", 500.0), (2015, "12", "Acre", 1.0), (2015, "13", "Amazonas", 1.0)],
        "ano INT, cod_uf STRING, uf STRING, pib_mil_reais DOUBLE",
    )
    people = spark.createDataFrame(
        [(2015, "11", "Rondônia", 100.0), (2015, "12", "Acre", 0.0)],
        "ano INT, cod_uf STRING, uf STRING, populacao DOUBLE",
    )
    table = ind.gdp_per_capita(gdp, people)
    assert rows(table, "uf", "pib_per_capita_reais") == [("Acre", None), ("Rondônia", 5000.0)]
    assert rows(ind.state_population(table, state_dim(spark)), "sigla_uf", "populacao") == [
        ("AC", 0.0),
        ("RO", 100.0),
    ]


def test_unknown_state_codes_do_not_clash(spark):
    per_head = spark.createDataFrame(
        [(2015, "11", 10.0), (2015, "98", 1.0), (2015, "99", 2.0)], "ano INT, cod_uf STRING, populacao DOUBLE"
    )
    links = spark.createDataFrame([(2015, "RO", "1")], schemas.EMPLOYMENT_LINKS)
    population = ind.state_population(per_head, state_dim(spark))
    got = ind.formal_employment(links, population, 2015, 2015)
    assert rows(got, "sigla_uf", "vinculos_por_mil_habitantes") == [("RO", 100.0)]


def test_school_and_development_index(spark):
    schools = spark.createDataFrame(
        [
            (2015, "XX", "estadual", "médio", "todos", 4.0, 90.0),
            (2015, "XX", "municipal", "médio", "todos", 5.0, 90.0),
            (2015, "XX", "estadual", "fundamental", "iniciais", None, 90.0),
            (2013, "XX", "estadual", "médio", "todos", 3.0, 90.0),
        ],
        schemas.SCHOOL_INDEX,
    )
    assert rows(ind.school_index(schools, 2015, 2017), "ideb") == [(4.0,)]
    development = spark.createDataFrame(
        [(2010, "XX", 0.7, 0.6, 0.8, 0.65), (2010, "YY", None, 0.1, 0.1, 0.1)], schemas.DEVELOPMENT_INDEX
    )
    got = ind.development_index(development)
    assert rows(got, "sigla_uf", "idhm", "idhm_educacao", "idhm_longevidade", "idhm_renda") == [
        ("XX", 0.7, 0.6, 0.8, 0.65)
    ]


def test_governors(spark):
    def row(year, state, turn, name, party, office="governador", result="eleito"):
        return (year, state, turn, office, result, name, party)

    results = spark.createDataFrame(
        [
            row(2014, "GO", 1, "P", "p1"),
            row(2014, "GO", 2, "P", "p1"),
            row(2014, "GO", 2, "Q", "p1", result="nao eleito"),
            row(2014, "GO", 2, "R", "p1", office="senador"),
            row(2014, "AM", 2, "A", "p2"),
            row(2014, "AM", 2, "B", "p3"),
            row(2018, "ZZ", 1, "C", "p4"),
            row(2018, "ZZ", 2, "C", "p5"),
        ],
        schemas.ELECTION_RESULTS,
    )
    terms = ind.governors(results, 2010, 2022)
    assert terms.columns == [
        "ano_eleicao", "sigla_uf", "nome_candidato", "sigla_partido", "inicio_mandato", "fim_mandato",
        "requer_revisao_manual",
    ]
    assert rows(terms) == [
        (2014, "AM", "A", "p2", None, None, True),
        (2014, "AM", "B", "p3", None, None, True),
        (2014, "GO", "P", "p1", dt.date(2015, 1, 1), dt.date(2018, 12, 31), False),
        (2018, "ZZ", "C", "p4", None, None, True),
        (2018, "ZZ", "C", "p5", None, None, True),
    ]
    assert rows(ind.unlisted_double_terms(terms)) == [(2018, "ZZ")]
