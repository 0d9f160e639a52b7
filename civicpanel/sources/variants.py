"""JSON of unknown shape: records of one line each, keys and leaves without a stated schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE = "_variante"


def read_records(spark: SparkSession, path: str, name: str = "registro") -> DataFrame:
    """JSON records, one per line, so that tasks share a large file; a line that is no JSON is NULL."""
    return parsed(spark.read.text(path), "value", name).drop("value")


def parsed(df: DataFrame, json: str, name: str) -> DataFrame:
    """Add a text column as a variant; text that is no JSON is NULL."""
    return df.withColumn(name, F.try_parse_json(json))


def entries(df: DataFrame, variant: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, pos, chave, valor): a row for each entry of an object or array; others have none. Arrays have no keys."""
    narrow = df.select(*keep, F.col(variant).alias(VALUE))
    columns = "".join(f"`{c}`, " for c in keep)
    return df.sparkSession.sql(
        f"SELECT {columns} e.pos AS pos, e.key AS chave, e.value AS valor FROM {{rows}}, LATERAL variant_explode({VALUE}) e", rows=narrow
    )


def leaves(df: DataFrame, variant: str, keep: Sequence[str] = (), depth: int = 8) -> DataFrame:
    """(keep, caminho, valor): every scalar of a variant with its path, such as ``$.a[0].b``, as text.

    One step per level, and as many as ``depth``; what lies deeper comes as JSON text, so nothing is lost.
    JSON nulls are NULL.
    """
    level = df.select(*keep, F.lit("$").alias("caminho"), F.col(variant).alias("valor")).where(F.col("valor").isNotNull())
    found = []
    for _ in range(depth):
        nested = F.schema_of_variant("valor").rlike("^(OBJECT|ARRAY)")
        found.append(level.where(~nested))
        below = entries(level.where(nested), "valor", [*keep, "caminho"])
        step = F.when(F.col("chave").isNotNull(), F.concat(F.lit("."), "chave")).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        level = below.select(*keep, F.concat("caminho", step).alias("caminho"), "valor")
    found.append(level)
    return reduce(DataFrame.unionByName, found).select(*keep, "caminho", F.col("valor").cast("string").alias("valor"))
