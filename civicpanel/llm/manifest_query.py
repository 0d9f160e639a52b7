"""The manifest of ``documents`` with tampered texts, and the same in SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicpanel.llm import merkle
from civicpanel.llm.common import tables
from civicpanel.llm.registry import query

FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
LEAF = " || ".join(FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars"))
LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, round: xor(v >> 1, 3988292384 * (v & 1)))))"""
BESIDE = "coalesce(string_agg(h, '' ORDER BY i) OVER (PARTITION BY {} ORDER BY i ROWS BETWEEN {}), '')"


def kin(by: str) -> str:
    left = BESIDE.format(by, "UNBOUNDED PRECEDING AND 1 PRECEDING")
    return f"{left} AS l, {BESIDE.format(by, '1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r"


MANIFEST_SQL = f"""WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS id, doc_id, lang, sha256({LEAF} || {FIELD.format('text')}) AS h,
      CASE WHEN doc_id IS NOT NULL AND {CRC} % 3 = 0 THEN sha256({LEAF} || {FIELD.format(LOWERED)})
           ELSE sha256({LEAF} || {FIELD.format('text')}) END AS tampered
    FROM documents),
  placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
  nodes(level, lang, i, n, h) AS (
    SELECT 0, lang, i, n, h FROM placed
    UNION ALL SELECT level + 1, lang, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
    FROM nodes WHERE n > 1 GROUP BY level, lang, i // 8, n),
  members AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
    FROM nodes WHERE n = 1),
  tops(level, i, n, h) AS (
    SELECT 0, i, n, h FROM members
    UNION ALL SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
    FROM tops WHERE n > 1 GROUP BY level, i // 8, n),
  beside AS (SELECT level, lang, i, {kin('level, lang, i // 8')} FROM nodes WHERE n > 1),
  above AS (SELECT level, i, {kin('level, i // 8')} FROM tops WHERE n > 1),
  steps AS (
    SELECT id, level, l, r FROM placed p JOIN beside b
      ON p.lang IS NOT DISTINCT FROM b.lang AND p.i // (8 ** level)::BIGINT = b.i
    UNION ALL SELECT id, 1000 + level, l, r FROM placed p JOIN members m ON p.lang IS NOT DISTINCT FROM m.lang
      JOIN above a ON m.i // (8 ** level)::BIGINT = a.i),
  paths AS (SELECT id, string_agg(l || r, '' ORDER BY level) AS proof, list({{'l': l, 'r': r}} ORDER BY level) AS path
    FROM steps GROUP BY id)
  SELECT doc_id, p.h AS leaf, m.h AS subroot, t.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend({{'l': tampered, 'r': ''}}, coalesce(path, [])),
      lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root, folded_root = t.h AS verified
  FROM placed p JOIN members m ON p.lang IS NOT DISTINCT FROM m.lang JOIN tops t ON t.n = 1 LEFT JOIN paths USING (id)"""


@query("op13_manifest", MANIFEST_SQL)
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof; the proof of a tampered third is checked and fails where the text changed."""
    docs = tables(spark, folder, "documents").select(*merkle.FIELDS)
    plain = [F.col(f) for f in merkle.FIELDS]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(third, merkle.leaf_digest([*plain[:-1], lowered]))
    found = merkle.merkle(docs.withColumn("tampered", tampered), keep=["tampered"])
    checked = merkle.verified(found.withColumn("tampered", F.coalesce("tampered", "leaf")), "tampered")
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
