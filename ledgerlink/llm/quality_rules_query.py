"""Query and SQL of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import quality_rules as op
from ledgerlink.llm.frames import table

GROUPS = ["lang", "source"]


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, metrics, kept = op.quality_rules(table(spark, sf_dir, "documents"), GROUPS, keep_columns=["doc_id", *GROUPS])
    m = F.col(metrics)
    return rows.select("doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       op.base_failed(m).alias("base_failed"), F.col(kept).alias("kept"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (
  SELECT rid, unnest(ws[1:len(ws) - 2]) AS a, unnest(ws[2:len(ws) - 1]) AS b, unnest(ws[3:]) AS c,
         unnest(range(1, len(ws) - 1)) AS k FROM w WHERE len(ws) > 2),
r AS (SELECT rid, k FROM p QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
q AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest([k, k + 1, k + 2]) AS place FROM r) GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(q.n, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines, len(regexp_extract_all(t, '\p{Lu}'))::BIGINT AS n_capitals,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclaims
  FROM w LEFT JOIN q USING (rid)),
j AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
v AS (
  SELECT rid, lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'capitals', 'exclaims']) AS metric,
         unnest([15, 150, 120, 60, 60]) AS least,
         unnest([1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1),
                 1000 * n_capitals // greatest(word_chars, 1), 1000 * n_exclaims // greatest(n_words, 1)]) AS value
  FROM j WHERE NOT base_failed),
s AS (
  SELECT lang, source, metric, least, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) AS bucket, count(*) AS n
  FROM v GROUP BY ALL),
l AS (
  SELECT 0 AS level, NULL AS lang, NULL AS source, metric, least, bucket, sum(n) AS n FROM s GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, metric, least, bucket, sum(n) FROM s GROUP BY ALL
  UNION ALL SELECT 2, lang, source, metric, least, bucket, sum(n) FROM s GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, metric) AS total FROM l),
f AS (
  SELECT level, lang, source, metric, max(total) AS total, max(least) AS least,
         min(bucket) FILTER (4 * upto >= total) AS q25, min(bucket) FILTER (4 * upto >= 3 * total) AS q75
  FROM c GROUP BY level, lang, source, metric),
g AS (SELECT level, lang, source, metric, total, q75 + 3 * greatest(q75 - q25, least) AS fence, q75 - q25 <= least AS tight FROM f),
-- upwards: a wider group's value is the lower median of its parts' with 100 texts or more
v2 AS (SELECT *, fence AS value FROM g WHERE level = 2),
v1 AS (
  SELECT *, coalesce((SELECT list_sort(list(p.value))[(count(*) + 1) // 2] FROM v2 p
                      WHERE p.metric = g.metric AND p.lang IS NOT DISTINCT FROM g.lang AND p.total >= 100), fence) AS value FROM g WHERE level = 1),
v0 AS (
  SELECT *, coalesce((SELECT list_sort(list(p.value))[(count(*) + 1) // 2] FROM v1 p WHERE p.metric = g.metric AND p.total >= 100), fence) AS value
  FROM g WHERE level = 0),
-- downwards: at most twice (four times, if its quartiles are close) the lower median of its siblings
r1 AS (
  SELECT b.lang, b.metric, b.total, b.tight, b.value, a.value AS above,
         (SELECT list_sort(list(o.value))[(count(*) + 1) // 2] FROM v1 o WHERE o.metric = b.metric AND o.total >= 100 AND o.lang IS DISTINCT FROM b.lang) AS reference
  FROM v1 b JOIN v0 a ON a.metric = b.metric),
f1 AS (SELECT *, CASE WHEN total >= 100 THEN least(value, CASE WHEN tight THEN 4 ELSE 2 END * reference) ELSE above END AS best FROM r1),
r2 AS (
  SELECT b.lang, b.source, b.metric, b.total, b.tight, b.value, a.best AS above,
         coalesce((SELECT list_sort(list(o.value))[(count(*) + 1) // 2] FROM v2 o
                   WHERE o.metric = b.metric AND o.total >= 100 AND o.lang IS NOT DISTINCT FROM b.lang AND o.source IS DISTINCT FROM b.source), a.reference) AS reference
  FROM v2 b JOIN f1 a ON a.metric = b.metric AND a.lang IS NOT DISTINCT FROM b.lang),
f2 AS (SELECT *, CASE WHEN total >= 100 THEN least(value, CASE WHEN tight THEN 4 ELSE 2 END * reference) ELSE above END AS best FROM r2),
bad AS (
  SELECT DISTINCT v.rid FROM v JOIN f2 ON v.metric = f2.metric AND v.lang IS NOT DISTINCT FROM f2.lang
    AND v.source IS NOT DISTINCT FROM f2.source WHERE v.value > f2.best)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM j
"""
