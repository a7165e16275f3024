"""Query and SQL of the conversation prefix trie, over conversations rebuilt so that beginnings repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import prefix_trie as op
from ledgerlink.llm.frames import stage, table

# Fixed rule of the query: a conversation takes its first h turns from the one whose id is the hundred below.
HUNDRED, HEADS = 100, 6


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, rows) for ``prefix_trie``: each conversation c begins with the first h = crc32(c) % 6 turns of conversation c - c % 100,
    followed by its own turns after the first h."""
    own = stage(op.turns(conversations), "turns")
    convs = own.groupBy("conv").agg(F.count("*").alias("n_own")).withColumns({
        "h": F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS, "base": F.col("conv") - F.col("conv") % HUNDRED})
    bases = convs.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0)))).withColumn(
        "n", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    convs = stage(convs.select("conv", "n", "h", "base", "n_head"), "members")
    heads = own.filter(f"k < {HEADS} and conv % {HUNDRED} = 0").withColumnRenamed("conv", "base")
    begin = convs.filter("h > 0").join(heads, "base").filter("k <= h").select("conv", "n", F.col("k").alias("d"), "content", "chars")
    rest = own.join(convs, "conv").filter("k > h").select("conv", "n", (F.col("k") - F.col("h") + F.col("n_head")).alias("d"), "content", "chars")
    return convs.select("conv", "n"), begin.unionByName(rest)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.prefix_trie(*rebuilt(table(spark, sf_dir, "conversations"))).drop("screened")


SQL = r"""
WITH RECURSIVE poly(i, v, s) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), s + 1 FROM poly WHERE s < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM poly WHERE s = 8),
r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id AS c, x, length(body)::BIGINT AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS k FROM r),
m AS (
  SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT)),
         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 6 AS h
  FROM (SELECT DISTINCT c FROM o), crc),
p AS (
  SELECT m.c, k AS d, x, chars FROM m JOIN o ON o.c = m.c - m.c % 100 AND k <= h
  UNION ALL
  SELECT m.c, k - h + (SELECT count(*) FROM o b WHERE b.c = m.c - m.c % 100 AND b.k <= h), x, chars FROM m JOIN o ON o.c = m.c AND k > h),
q AS (
  SELECT c, d, chars, sha256(string_agg(x, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM p
  UNION ALL SELECT c, 0, 0, 'root' FROM m),
e AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS above, max(d) OVER (PARTITION BY c) AS n FROM q),
g AS (
  SELECT node, any_value(above) AS above, any_value(d) AS d, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n), '')) AS ends FROM e GROUP BY node),
k AS (SELECT above AS node, count(*) AS n_children FROM g WHERE above IS NOT NULL GROUP BY above),
f AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (node)),
u AS (
  SELECT e.node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM f JOIN e ON e.c = f.c AND e.d <= f.d GROUP BY e.node)
SELECT f.c AS conv_id, f.d AS depth, a.c AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends AS ends_sha256
FROM f JOIN u USING (node) LEFT JOIN g a ON a.node = f.above
"""
