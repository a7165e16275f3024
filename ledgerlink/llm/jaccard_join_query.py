"""Query and SQL of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import jaccard_join as op
from ledgerlink.llm.frames import table


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op.jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_runs").alias("n_shingles"), "component_id")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS z FROM d UNION SELECT l.y, r.z FROM r JOIN l ON l.x = r.x),
m AS (SELECT x, min(z) AS z FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.z AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = d.doc_id
"""
