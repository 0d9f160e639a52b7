import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel import schemas
from civicpanel.functions.parameters import Years
from civicpanel.operators import filters, lookups
from civicpanel.plans import indicators as ind
from civicpanel.plans import star
from civicpanel.sources import frames, nested, tables

RESPONSE = [
    {
        "id": "1940",
        "resultados": [
            {
                "classificacoes": [
                    {"id": "2", "categoria": {"6794": "Total"}},
                    {"id": "1933", "categoria": {"49031": "2015"}},
                ],
                "series": [
                    {"localidade": {"id": "11", "nome": "Rondonia"}, "serie": {"2018": "20.1"}},
                    {"localidade": {"id": "12", "nome": "Acre"}, "serie": {"2018": "..."}},
                ],
            }
        ],
    },
    {"id": "x"},
]


@pytest.fixture
def landed(tmp_path):
    path = tmp_path / "landed"
    path.mkdir()
    (path / "r.json").write_text(json.dumps(RESPONSE, indent=1))
    return str(path)


def test_nested_series_from_file_and_column(spark, landed):
    blocks = nested.read_series_blocks(spark, landed)
    by_class = ind.infant_mortality_official(blocks)
    assert by_class.columns == ["ano", "cod_uf", "uf", "taxa_mortalidade_infantil_oficial"]
    assert rows(by_class) == [(2015, "11", "Rondonia", 20.1)]
    assert rows(ind.gini(blocks)) == [(2018, "11", "Rondonia", 20.1)]
    text = spark.createDataFrame([("k", json.dumps(RESPONSE))], "k STRING, j STRING")
    parsed = nested.parse_series_blocks(text, "j", "k")
    assert rows(nested.flatten_series(parsed, "v", "k")) == [("k", 2018, "11", "Rondonia", 20.1)]


def test_series_without_the_classification_has_no_year(spark):
    response = [{"id": "b", "resultados": [{"series": RESPONSE[0]["resultados"][0]["series"]}]}]
    text = spark.createDataFrame([(json.dumps(response),)], "j STRING")
    blocks = nested.parse_series_blocks(text, "j")
    assert rows(nested.flatten_series_by_class(blocks, "v", "1933"), "ano", "cod_uf") == [(None, "11")]


def test_a_word_in_place_of_a_number_is_an_error(spark):
    response = [{"resultados": [{"series": [{"localidade": {"id": "1", "nome": "a"}, "serie": {"2018": "n/d"}}]}]}]
    text = spark.createDataFrame([(json.dumps(response),)], "j STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        nested.flatten_series(nested.parse_series_blocks(text, "j"), "v").collect()


def test_unemployment_mean_of_available_quarters(spark):
    serie = {"201501": "10", "201502": "12", "201503": "14", "201504": "...", "201601": "-"}
    response = [{"resultados": [{"series": [{"localidade": {"id": "11", "nome": "R"}, "serie": serie}]}]}]
    text = spark.createDataFrame([(json.dumps(response),)], "j STRING")
    got = ind.unemployment(nested.parse_series_blocks(text, "j"))
    assert rows(got) == [(2015, "11", "R", 12.0, 3)]


def test_metadata(spark):
    meta = {
        "id": "6579",
        "nome": "t",
        "variaveis": [
            {"id": "1", "nome": "População residente", "unidade": "Pessoas"},
            {"id": "2", "nome": "PIB PER CAPITA"},
            {"id": "3", "nome": "Área"},
        ],
        "classificacoes": [
            {"id": "2", "nome": "Sexo", "categorias": [{"id": "6794", "nome": "Total"}]},
            {"id": "9", "nome": "Outra"},
        ],
    }
    text = spark.createDataFrame([(json.dumps(meta),)], "j STRING")
    parsed = nested.parse_metadata(text, "j")
    assert rows(nested.metadata_variables(parsed), "id", "unidade", "populacional") == [
        ("1", "Pessoas", True),
        ("2", None, True),
        ("3", None, False),
    ]
    assert rows(nested.metadata_categories(parsed)) == [
        ("2", "Sexo", "6794", "Total"),
        ("9", "Outra", None, None),
    ]


def indicator_tables(spark):
    return {
        "gini_uf": spark.createDataFrame(
            [(2015, "11", "Rondônia", 0.5), (2015, "99", "Nenhum", 0.4), (2016, "12", "Acre", None)],
            schemas.INDICATOR_TABLES["gini_uf"],
        ),
        "idhm_uf": spark.createDataFrame(
            [(2010, "AC", 0.7, 0.6, None, 0.65)], schemas.INDICATOR_TABLES["idhm_uf"]
        ),
        "despesas_funcao_uf": spark.createDataFrame(
            [(2015, "AC", "Saúde", "e", 10.0), (2015, "AC", None, "e", 99.0)],
            schemas.INDICATOR_TABLES["despesas_funcao_uf"],
        ),
        "ideb_uf": spark.createDataFrame(
            [(2015, "AC", "médio", "todos", 4.0, 90.0), (2015, "AC", "médio", None, 3.0, 90.0)],
            schemas.INDICATOR_TABLES["ideb_uf"],
        ),
    }


FACT_ROWS = [
    (2010, "AC", "3_idhm", "", 0.7),
    (2010, "AC", "3_idhm", "educacao", 0.6),
    (2010, "AC", "3_idhm", "renda", 0.65),
    (2015, "AC", "4_despesa_funcao", "Saúde", 10.0),
    (2015, "AC", "8_ideb", "médio_todos", 4.0),
    (2015, "RO", "2_gini", "", 0.5),
    (2015, None, "2_gini", "", 0.4),
]


def test_consolidate_keeps_empty_dimension_and_unknown_codes(spark, tmp_path):
    fact = star.consolidate(indicator_tables(spark), frames.state_dim(spark))
    assert fact.columns == ["ano", "sigla_uf", "id_indicador", "dimensao", "valor"]
    assert rows(fact) == FACT_ROWS
    assert rows(lookups.unmapped(fact, "sigla_uf"), "valor") == [(0.4,)]
    written = tables.write_star(
        str(tmp_path), fact, frames.state_dim(spark), frames.indicator_dim(spark)
    )
    assert written == ["dim_estado", "dim_indicador", "fato_indicador"]
    back = tables.read_star(spark, str(tmp_path))
    assert rows(back["fato_indicador"], "ano", "sigla_uf", "id_indicador", "dimensao", "valor") == FACT_ROWS
    assert back["dim_estado"].count() == 27 and back["dim_indicador"].count() == 12
    assert back["dim_governador"] is None
    one = tables.indicator_slice(back["fato_indicador"], "3_idhm")
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(id_indicador" in one._jdf.queryExecution().toString()


def test_writing_replaces_and_includes_terms(spark, tmp_path):
    fact = spark.createDataFrame([FACT_ROWS[0]], schemas.FACT)
    terms = spark.createDataFrame([(2014, "AC", "a", "b", None, None, True)], schemas.TERM_DIM)
    for _ in range(2):
        written = tables.write_star(
            str(tmp_path), fact, frames.state_dim(spark), frames.indicator_dim(spark), terms
        )
    assert "dim_governador" in written
    assert tables.read_star(spark, str(tmp_path))["fato_indicador"].count() == 1
    assert rows(star.dry_run({"a": fact, "b": terms, "c": None})) == [("a", 1), ("b", 1)]


def test_fact_without_year_or_parts_is_an_error(spark):
    bad = spark.createDataFrame([(None, "AC", 0.7, 0.6, 0.5, 0.65)], schemas.INDICATOR_TABLES["idhm_uf"])
    with pytest.raises(Exception, match="fact row without a year"):
        star.consolidate({"idhm_uf": bad}, frames.state_dim(spark)).collect()
    with pytest.raises(ValueError):
        star.consolidate({}, frames.state_dim(spark))


def test_indicator_csvs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_indicator_csvs(spark, str(tmp_path))
    gini = spark.createDataFrame([(2015, "11", "Rondônia", 0.5)], schemas.INDICATOR_TABLES["gini_uf"])
    assert tables.write_csv(gini, f"{tmp_path}/gini_uf.csv") == 1
    found, absent = tables.read_indicator_csvs(spark, str(tmp_path))
    assert list(found) == ["gini_uf"] and len(absent) == 11
    assert rows(star.consolidate(found, frames.state_dim(spark))) == [(2015, "RO", "2_gini", "", 0.5)]
    # Written by another tool: one file, other column order, one column more.
    (tmp_path / "ideb_uf.csv").write_text(
        "sigla_uf,ano,ideb,taxa_aprovacao,ensino,anos_escolares,nota\nAC,2015,4.0,,médio,todos,x\n"
    )
    (tmp_path / "governadores_uf.csv").write_text(
        "ano_eleicao,sigla_uf,nome_candidato,sigla_partido,inicio_mandato,fim_mandato,requer_revisao_manual\n"
        "2014,AC,A,P,2015-01-01,2018-12-31,False\n2014,AM,B,P,,,True\n"
    )
    found, _ = tables.read_indicator_csvs(spark, str(tmp_path))
    assert rows(star.consolidate(found, frames.state_dim(spark)), "id_indicador", "dimensao", "valor") == [
        ("2_gini", "", 0.5), ("8_ideb", "médio_todos", 4.0),
    ]
    assert rows(found["governadores_uf"], "sigla_uf", "fim_mandato", "requer_revisao_manual") == [
        ("AC", dt.date(2018, 12, 31), False), ("AM", None, True),
    ]
    whole = star.consolidate_folder(spark, str(tmp_path))
    assert rows(whole.counts()) == [("dim_estado", 27), ("dim_governador", 2), ("dim_indicador", 12), ("fato_indicador", 2)]
    assert rows(whole.counts_by_indicator(), "id_indicador") == [("2_gini",), ("8_ideb",)]
    assert len(whole.absent) == 9
    assert set(whole.write(f"{tmp_path}/star")) == {"dim_estado", "dim_indicador", "dim_governador", "fato_indicador"}
    names = [r.nome_uf for r in tables.read_states(spark, f"{tmp_path}/star").collect()]
    assert len(names) == 27 and names == sorted(names)
    ids = [r.id_indicador for r in tables.read_indicators(spark, f"{tmp_path}/star").collect()]
    assert ids == sorted(ids)
    frames.state_dim(spark).withColumnRenamed("regiao", "regiaum").write.parquet(f"{tmp_path}/bad/dim_estado")
    with pytest.raises(ValueError, match="no column regiao"):
        tables.read_states(spark, f"{tmp_path}/bad")


def test_database_options():
    options = tables.jdbc_options("jdbc:x", "fato_indicador", {"user": "u"})
    assert options == {"user": "u", "url": "jdbc:x", "dbtable": "fato_indicador", "batchsize": "5000"}


def test_literal_dimensions(spark):
    states = frames.state_dim(spark)
    assert states.count() == 27
    assert rows(states.groupBy("regiao").count()) == [
        ("Centro-Oeste", 4), ("Nordeste", 9), ("Norte", 7), ("Sudeste", 4), ("Sul", 3),
    ]
    assert rows(states.where("sigla_uf = 'DF'")) == [("53", "DF", "Distrito Federal", "Centro-Oeste")]
    assert frames.year_categories(spark).count() == 61
    categories = frames.year_categories(spark)
    assert rows(lookups.missing_years(categories, 1998, 2001)) == [(1998,), (1999,)]
    assert rows(lookups.covered_years(categories, 2014, 2016)) == [
        (2014, "49030"), (2015, "49031"), (2016, "49032"),
    ]
    assert frames.literal_frame(spark, [], "a INT").count() == 0
    assert frames.literal_frame(spark, [(1, None)] * 20_000, "a INT, b STRING").count() == 20_000
    assert "LocalTableScan" in frames.state_dim(spark)._jdf.queryExecution().executedPlan().toString()


def test_keys(spark):
    states = frames.state_dim(spark)
    coded = spark.createDataFrame([(11, 1.0), (99, 2.0)], "cod_uf INT, v DOUBLE")
    assert rows(lookups.resolve_state(coded, states), "sigla_uf", "v") == [("RO", 1.0), (None, 2.0)]
    with pytest.raises(ValueError):
        lookups.resolve_state(coded.select("v"), states)
    text = coded.withColumn("cod_uf", F.col("cod_uf").cast("string"))
    kept = lookups.map_codes(text, states, "cod_uf", "sigla_uf", "uf", keep_unknown=True)
    assert rows(kept, "uf") == [("99",), ("RO",)]


def test_year_specification(spark):
    span, listed = Years.parse("2015-2018"), Years.parse("2015, 2018")
    df = spark.range(2013, 2020).selectExpr("cast(id AS INT) AS ano")
    assert [r.ano for r in df.where(span.matches("ano")).collect()] == [2015, 2016, 2017, 2018]
    assert [r.ano for r in df.where(listed.matches("ano")).collect()] == [2015, 2018]
    assert listed.span() == span


def test_has_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v DOUBLE")
    assert not filters.has_values(df, "v")
    assert not filters.has_values(df.where("false"), "v")
    assert filters.has_values(df.union(spark.createDataFrame([(1.0,)], "v DOUBLE")), "v")


def test_fixed_values():
    assert len(fv.STATES) == 27 and len(fv.INDICATORS) == 12
    assert fv.YEAR_CATEGORIES[2013] == "49029" and fv.YEAR_CATEGORIES[2060] == "49076"
