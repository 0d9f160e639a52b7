"""Small frames written out in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from civicpanel import fixed_values as fv
from civicpanel import schemas

def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame from in-code rows of any number.

    They are handed over as one Arrow table, so Catalyst knows their size and broadcasts
    them, or not, by its own check.
    """
    kind = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(kind)
    arrays = [pa.array(c, type=to_arrow_type(f.dataType)) for c, f in zip(columns, kind)]
    return spark.createDataFrame(pa.table(arrays, names=kind.names), kind)


def state_dim(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [(code, *rest) for code, rest in fv.STATES.items()], schemas.STATE_DIM)


def indicator_dim(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, fv.INDICATORS, schemas.INDICATOR_DIM)


def year_categories(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, list(fv.YEAR_CATEGORIES.items()), "ano INT, id_categoria STRING")
