"""Checks that report and never correct."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel import fixed_values as fv
from civicpanel.sources.frames import literal_frame

RULES = "id_indicador STRING, minimo DOUBLE, maximo DOUBLE"


def plausibility_violations(fact: DataFrame, rules: DataFrame) -> DataFrame:
    """Fact rows outside the bounds of their indicator; a NULL bound is open."""
    low, high = F.col("minimo"), F.col("maximo")
    outside = F.coalesce(F.col("valor") < low, F.lit(False)) | F.coalesce(F.col("valor") > high, F.lit(False))
    return fact.join(rules, "id_indicador").where(outside)


def coverage(fact: DataFrame, expected: int) -> DataFrame:
    """Entities present per indicator and year, against the expected number."""
    present = fact.groupBy("id_indicador", "ano").agg(F.countDistinct("sigla_uf").alias("presentes"))
    return present.withColumn("completo", F.col("presentes") >= F.lit(expected))


def coverage_gaps(
    present: DataFrame, entities: DataFrame, first: int, last: int, key: str = "sigla_uf", time: str = "ano"
) -> DataFrame:
    """(entity, year) pairs that should be there and are not."""
    wanted = entities.select(key, F.explode(F.sequence(F.lit(first), F.lit(last))).alias(time))
    return wanted.join(present.select(key, time), [key, time], "left_anti")


def within_validity(
    fact: DataFrame, spark: SparkSession, valid_until: Mapping[str, int] = fv.VALID_UNTIL
) -> DataFrame:
    """Drop projected years after the last usable year of an indicator."""
    limits = literal_frame(spark, list(valid_until.items()), "id_indicador STRING, _ate INT")
    joined = fact.join(limits, "id_indicador", "left")
    return joined.where(F.col("_ate").isNull() | (F.col("ano") <= F.col("_ate"))).select(*fact.columns)
