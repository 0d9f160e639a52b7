"""Readers and writers of stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civicpanel import schemas


STAR = {
    "fato_indicador": schemas.FACT,
    "dim_estado": schemas.STATE_DIM,
    "dim_indicador": schemas.INDICATOR_DIM,
    "dim_governador": schemas.TERM_DIM,
}


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    source: str = "parquet",
    **options: str,
) -> DataFrame:
    """One table. ``source`` is any Spark data source; parquet by default."""
    reader = spark.read.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_if_present(
    spark: SparkSession, path: str, schema: str | None = None, source: str = "parquet", **options: str
) -> DataFrame | None:
    """The table, or None when its path does not exist."""
    try:
        return read_table(spark, path, schema, source, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def typed(table: DataFrame, schema: str) -> DataFrame:
    """Columns of a text table by name, cast to the schema; others are dropped.

    A schema given to the CSV reader would be matched by position instead.
    """
    fields = StructType.fromDDL(schema).fields
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def read_indicator_csvs(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Per-indicator CSV tables of a folder: the present ones, and names of the absent.

    All absent is an error.
    """
    found, absent = {}, []
    for name, schema in schemas.INDICATOR_TABLES.items():
        table = read_if_present(spark, f"{folder}/{name}.csv", source="csv", header="true")
        if table is None:
            absent.append(name)
        else:
            found[name] = typed(table, schema)
    if not set(found) - {"governadores_uf"}:
        raise FileNotFoundError(f"no indicator table under {folder}")
    return found, absent


def write_csv(df: DataFrame, path: str) -> int:
    """Write CSV with a header and return the row count seen by the same job."""
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return rows.get["rows"]


def write_star(
    folder: str,
    fact: DataFrame,
    states: DataFrame,
    indicators: DataFrame,
    terms: DataFrame | None = None,
) -> list[str]:
    """Replace the star schema as parquet; the term table is optional.

    The rebalance hint lets adaptive execution split the files of a large indicator
    and merge those of small ones, so no indicator is written by one task.
    """
    tables = {"dim_estado": states, "dim_indicador": indicators}
    if terms is not None:
        tables["dim_governador"] = terms
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    (
        fact.hint("rebalance", "id_indicador")
        .write.mode("overwrite")
        .partitionBy("id_indicador")
        .parquet(f"{folder}/fato_indicador")
    )
    return [*tables, "fato_indicador"]


def with_columns_of(table: DataFrame | None, schema: str) -> DataFrame | None:
    """The columns of a schema; a table that lacks one is an error, where a stated schema would read NULLs."""
    if table is None:
        return None
    names = StructType.fromDDL(schema).names
    if lacking := [n for n in names if n not in table.columns]:
        raise ValueError(f"no column {', '.join(lacking)} in a table with {', '.join(table.columns)}")
    return table.select(*names)


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    found = {}
    for name, schema in STAR.items():
        read = read_if_present if name == "dim_governador" else read_table
        found[name] = with_columns_of(read(spark, f"{folder}/{name}"), schema)
    return found


def read_states(spark: SparkSession, folder: str) -> DataFrame:
    """The stored states, by name."""
    return with_columns_of(read_table(spark, f"{folder}/dim_estado"), schemas.STATE_DIM).orderBy("nome_uf")


def read_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """The stored catalogue, by id."""
    return with_columns_of(read_table(spark, f"{folder}/dim_indicador"), schemas.INDICATOR_DIM).orderBy("id_indicador")


def database_writer(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> DataFrameWriter:
    """Writer that replaces one database table in batches of 5,000; call ``.save()``."""
    return (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**jdbc_options(url, table, properties))
    )


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    return {**(properties or {}), "url": url, "dbtable": table, "batchsize": "5000"}


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, folder: str) -> DataFrame:
    """Store a table in buckets of its keys, sorted by them, and read it back.

    Two tables with as many buckets are joined on their keys without a shuffle. NULL keys
    have a bucket like others and match nothing.
    """
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(name)
    return df.sparkSession.table(name)


def indicator_slice(fact: DataFrame, indicator: str) -> DataFrame:
    """One indicator of the fact table; prunes partitions of the stored table.

    The id is a bound parameter, never part of the query text.
    """
    return fact.sparkSession.sql(
        "SELECT ano, sigla_uf, dimensao, valor FROM {fact} WHERE id_indicador = :indicator",
        args={"indicator": indicator},
        fact=fact,
    )
