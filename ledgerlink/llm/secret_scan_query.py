"""Query and SQL of the secret scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import secret_scan as op
from ledgerlink.llm.frames import table

OWNER, REPOSITORY = "source", ["source", "lang"]


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = op.secret_spans(docs, owner_col=OWNER, repo_cols=REPOSITORY)
    written = F.concat_ws(":", "kind", "start", "end")
    # sorted by start, then by the kind's place in the list
    listed = lambda only: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(only, F.struct(
        F.col("start"), op.kind_rank(F.col("kind")).alias("k"), F.col("end"), written.alias("s"))))), lambda x: x["s"]), ",")
    base = F.col("kind").isin(*op.BASE)
    count = lambda what: F.count_if(what)
    per = spans.groupBy("id", "text_hash").agg(
        *[count(F.col("kind") == k).alias(f"n_{k}") for k in op.KINDS], count(base & F.col("live")).alias("n_live"), count(base & ~F.col("live")).alias("n_example"),
        listed(base).alias("base"), listed(F.lit(True)).alias("spans"))
    rows = docs.select("doc_id", op.text_hash(F.col("text")).alias("own_hash"))
    out = rows.join(per, rows["doc_id"].eqNullSafe(per["id"]) & (rows["own_hash"] == per["text_hash"]), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), zero("n_reuse"), zero("n_opaque"), zero("n_live"), zero("n_example"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
p AS (SELECT unnest(['assign', 'access', 'hex', 'opaque', 'wide']) AS kind, unnest([1, 2, 3, 0, 0]) AS k, unnest([
  '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
  '(AKIA[A-Z0-9]+)', '([0-9a-f]{16,})', '([A-Za-z0-9+/_-]{12,})', '([A-Za-z0-9+/_.=-]{12,})']) AS re),
m AS (
  SELECT rid, lang, source, kind, k, regexp_split_to_array(t, re) AS g, regexp_extract_all(t, re, 0) AS w, regexp_extract_all(t, re, 1) AS v FROM d, p),
x AS (SELECT rid, lang, source, kind, k, g, w, v, unnest(range(1, len(w) + 1)) AS j FROM m WHERE len(w) > 0),
c AS (
  SELECT rid, lang, source, kind, k, v[j] AS value, list_sum([length(s) for s in g[1:j]]) + coalesce(list_sum([length(s) for s in w[1:j - 1]]), 0) AS a,
         list_sum([length(s) for s in g[1:j]]) + list_sum([length(s) for s in w[1:j]]) AS z
  FROM x),
f AS (
  SELECT * FROM c WHERE CASE kind WHEN 'assign' THEN length(value) >= 12 WHEN 'access' THEN length(value) >= 18 WHEN 'hex' THEN true
                        WHEN 'opaque' THEN regexp_matches(value, '[0-9]|[a-z][A-Z]') ELSE regexp_matches(value, '[0-9]|[a-z][A-Z]') AND regexp_matches(value, '[.=]') END),
o AS (SELECT rtrim(value, '.=-') AS bare, count(DISTINCT coalesce(source, chr(1))) AS owners, bool_or(kind NOT IN ('opaque', 'wide')) AS in_base FROM f GROUP BY bare),
t AS (
  SELECT f.*, owners, in_base AND length(bare) >= 12 AND (kind = 'opaque' OR regexp_matches(bare, '[.=]')) AND kind IN ('opaque', 'wide') AS reused, in_base, bare
  FROM f JOIN o ON rtrim(f.value, '.=-') = bare),
n AS (
  SELECT rid, a::BIGINT AS a, CASE WHEN reused THEN a + length(bare) ELSE z END::BIGINT AS z, value, owners, kind NOT IN ('opaque', 'wide') AS base,
         CASE WHEN kind NOT IN ('opaque', 'wide') THEN kind WHEN reused THEN 'reuse'
              WHEN kind = 'opaque' AND NOT in_base AND owners < 5 AND length(value) >= 20 AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]') THEN 'opaque' END AS kind
  FROM t),
s AS (
  SELECT * FROM n WHERE kind IS NOT NULL AND (base OR NOT EXISTS (SELECT 1 FROM n b WHERE b.base AND b.rid = n.rid AND b.a < n.z AND b.z > n.a))),
q AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         count(*) FILTER (kind = 'reuse') AS n_reuse, count(*) FILTER (kind = 'opaque') AS n_opaque,
         count(*) FILTER (base AND owners < 5 AND NOT regexp_matches(value, '(?i)example|changeme|placeholder|your[_-]|xxxx|0123456789')) AS n_live,
         count(*) FILTER (base AND NOT (owners < 5 AND NOT regexp_matches(value, '(?i)example|changeme|placeholder|your[_-]|xxxx|0123456789'))) AS n_example,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, list_position(['assign', 'access', 'hex', 'reuse', 'opaque'], kind), z) FILTER (base) AS b,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, list_position(['assign', 'access', 'hex', 'reuse', 'opaque'], kind), z) AS e
  FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(e, '') AS spans, coalesce(n_reuse, 0)::BIGINT AS n_reuse, coalesce(n_opaque, 0)::BIGINT AS n_opaque,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN q USING (rid)
"""
