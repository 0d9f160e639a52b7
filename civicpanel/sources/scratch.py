"""Tables that a job writes for itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; where unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Folders of tables written in this process that ``clear`` has not deleted yet.
_WRITTEN: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of the shared one that nothing uses yet."""
    path = f"{shared_folder(spark)}/civicpanel/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Delete the tables stored so far, once their readers are done; how many there were."""
    gone = len(_WRITTEN)
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several others are derived from, and read it back.

    Its sources are then read once, and a lost executor costs a read of the small table.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
