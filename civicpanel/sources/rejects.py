"""CSV tables with bad lines: the good rows, and a report of the others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civicpanel import schemas

LINE = "_linha"


@dataclass(frozen=True)
class Parsed:
    """Rows that fit the schema, and (arquivo, linha) of lines that do not."""

    rows: DataFrame
    rejects: DataFrame

    def rejected_per_file(self) -> DataFrame:
        return self.rejects.groupBy("arquivo").agg(F.count(F.lit(1)).alias("linhas"))


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV table, from its first line."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: str, **options: str) -> Parsed:
    """A CSV table with a header, by column names.

    A line with more or fewer fields than the header, or with a field that is not of its
    type, is rejected whole. Columns that the schema lacks are ignored, whatever they hold;
    a column of the schema that the header lacks is an error. Empty fields are NULL.
    """
    wanted = StructType.fromDDL(schema)
    names = header(spark, path)
    if lacking := [n for n in wanted.names if n not in names]:
        raise ValueError(f"no column {', '.join(lacking)} in {path}")
    types = {f.name: f.dataType for f in wanted}
    fields = [StructField(n, types.get(n, StringType())) for n in names]
    reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, columnPruning="false", enforceSchema="true")
    lines = reader.options(header="true", **options).schema(StructType([*fields, StructField(LINE, StringType())])).csv(path)
    lines = lines.select("*", F.col("_metadata.file_path").alias("_file"))
    # Spark parses the fields that a query needs: a test that needs all of them, and that holds
    # for all lines, finds the bad ones whichever columns are read later.
    fields = F.length(F.concat_ws("", *[F.col(n).cast("string") for n in names])) >= 0
    good = lines.where(F.col(LINE).isNull() & fields).select(*wanted.names)
    bad = lines.where(F.col(LINE).isNotNull() & fields).select(F.col("_file").alias("arquivo"), F.col(LINE).alias("linha"))
    return Parsed(good, bad)


def read_good_indicators(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame, list[str]]:
    """Indicator tables of a folder, (tabela, arquivo, linha) of all rejected lines, and names of absent tables.

    All absent is an error, as for the strict reader.
    """
    found, rejects, absent = {}, spark.createDataFrame([], "tabela STRING, arquivo STRING, linha STRING"), []
    for name, schema in schemas.INDICATOR_TABLES.items():
        try:
            parsed = read_csv(spark, f"{folder}/{name}.csv", schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(name)
            continue
        found[name] = parsed.rows
        rejects = rejects.unionByName(parsed.rejects.select(F.lit(name).alias("tabela"), "arquivo", "linha"))
    if not set(found) - {"governadores_uf"}:
        raise FileNotFoundError(f"no indicator table under {folder}")
    return found, rejects, absent
