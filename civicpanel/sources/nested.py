"""Nested statistical JSON to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel import schemas
from civicpanel.functions.expressions import (
    first_map_value,
    first_match,
    mentions_any,
    number_or_missing,
)


def read_series_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one JSON array of blocks per file; one row per block."""
    return spark.read.schema(schemas.SERIES_BLOCK).option("multiLine", True).json(path)


def parse_series_blocks(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """The same from a column that holds the response text."""
    schema = f"ARRAY<STRUCT<{schemas.SERIES_BLOCK}>>"
    return df.select(*keep, F.inline(F.from_json(json, schema)))


def _series(blocks: DataFrame, *keep: str) -> DataFrame:
    """One row per (classification set, place); blocks without results give no row."""
    results = blocks.select(*keep, F.explode("resultados").alias("r"))
    return results.select(*keep, F.col("r.classificacoes").alias("classes"), F.explode("r.series").alias("s"))


def _points(series: DataFrame, value_name: str, time: Column, *keep: str) -> DataFrame:
    points = series.select(
        *keep,
        "classes",
        F.col("s.localidade.id").alias("cod_uf"),
        F.col("s.localidade.nome").alias("uf"),
        F.explode("s.serie").alias("periodo", "texto"),
    )
    return points.select(
        *keep, time, "cod_uf", "uf", number_or_missing("texto").alias(value_name)
    ).where(F.col(value_name).isNotNull())


def flatten_series(blocks: DataFrame, value_name: str, *keep: str) -> DataFrame:
    """(ano, cod_uf, uf, value): the year is the key of the series."""
    return _points(_series(blocks, *keep), value_name, F.col("periodo").cast("int").alias("ano"), *keep)


def flatten_periods(blocks: DataFrame, value_name: str, *keep: str) -> DataFrame:
    """(periodo, cod_uf, uf, value): the period key is kept as text."""
    return _points(_series(blocks, *keep), value_name, F.col("periodo"), *keep)


def flatten_series_by_class(
    blocks: DataFrame, value_name: str, classification: str, *keep: str
) -> DataFrame:
    """(ano, cod_uf, uf, value): the year is the label of a classification.

    The first classification with that id counts; the key of the series is ignored.
    """
    found = first_match("classes", lambda c: c["id"] == classification)
    year = first_map_value(found["categoria"]).cast("int").alias("ano")
    return _points(_series(blocks, *keep), value_name, year, *keep)


def parse_metadata(df: DataFrame, json: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.from_json(json, schemas.TABLE_METADATA).alias("m")).select(
        *keep, "m.*"
    )


def metadata_variables(meta: DataFrame, *keep: str) -> DataFrame:
    """(id, nome, unidade) of each variable, with a mark on population variables."""
    return (
        meta.select(*keep, F.explode("variaveis").alias("v"))
        .select(*keep, "v.id", "v.nome", "v.unidade")
        .withColumn("populacional", mentions_any("nome"))
    )


def metadata_categories(meta: DataFrame, *keep: str) -> DataFrame:
    """Classification x category; a classification without categories keeps one row."""
    return (
        meta.select(*keep, F.explode("classificacoes").alias("c"))
        .select(
            *keep,
            F.col("c.id").alias("id_classificacao"),
            F.col("c.nome").alias("classificacao"),
            F.explode_outer("c.categorias").alias("k"),
        )
        .select(
            *keep,
            "id_classificacao",
            "classificacao",
            F.col("k.id").alias("id_categoria"),
            F.col("k.nome").alias("categoria"),
        )
    )
