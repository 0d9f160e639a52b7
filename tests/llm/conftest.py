"""Documents with every awkward case the corpus operators must handle."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """Documents from (doc_id, text) pairs."""
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], DOCUMENTS)

    return make
