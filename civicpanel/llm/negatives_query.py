"""Hard negatives of ``embeddings``, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm import hard_negatives
from civicpanel.llm.common import tables
from civicpanel.llm.registry import query

NEGATIVES_SQL = """WITH rows AS (
    SELECT row_number() OVER () AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (SELECT a.id AS anchor, a.vec_id AS anchor_id, b.id, b.vec_id, a.label = b.label AS same,
      list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.id <> b.id),
  positives AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same QUALIFY place <= 5)
  SELECT p.anchor_id, p.vec_id AS positive_id,
    (row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
    AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
  QUALIFY rank <= 10"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth id; every seventh label is shifted first."""
    rows = tables(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)
