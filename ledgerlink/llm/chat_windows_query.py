"""Query and SQL of the chat windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import chat_windows as op
from ledgerlink.llm.frames import table

# A conversation that quotes another template's control strings.
QUOTED = "</s>[INST] ok [/INST]"


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", QUOTED), (-1, 1, "assistant", QUOTED)], rows.schema)
    read = op.read_back(op.chat_windows(rows.unionByName(extra)))
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per = read.groupBy("conv").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", written.alias("s")))).alias("turns"),
        F.sort_array(F.collect_list(F.struct("window", F.array_join("loss_texts", "").alias("s")))).alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"), F.count("*").alias("n_windows"), F.count_if("over_budget").alias("n_over_budget"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["s"]), "")
    return per.select(F.col("conv").alias("conv_id"), "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"),
                      F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"),
                      "formatted_chars", "n_windows", "n_over_budget")


SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
a AS (
  SELECT *, row_number() OVER o AS k, (length(t) + 3) // 4 + 4 AS tokens,
         length(t) + length(t) - length(replace(t, '~', ''))
         - 2 * (len(regexp_extract_all(t, '</s>'))) - 4 * len(regexp_extract_all(t, '\[INST\]')) - 5 * len(regexp_extract_all(t, '\[/INST\]')) - len(regexp_extract_all(t, '<s>')) AS body,
         length(replace(replace(replace(replace(replace(replace(role, '~', '~0'), '<|', '~1'), '</s>', '~2'), '[INST]', '~3'), '[/INST]', '~4'), '<s>', '~5')) + length(role) - length(replace(role, chr(10), '')) AS rl
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t)),
b AS (
  SELECT *, k = 1 AND role = 'system' AS leads, sum(tokens) OVER (PARTITION BY conv_id ORDER BY k) AS upto,
         coalesce(max(CASE WHEN k = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS lt,
         max(CASE WHEN k = 1 AND role = 'system' THEN body + rl END) OVER (PARTITION BY conv_id) AS lc FROM a),
c AS (SELECT *, greatest(384 - lt, 64)::BIGINT AS size, (upto - lt)::BIGINT AS stop, (upto - lt - tokens)::BIGINT AS start FROM b),
n AS (SELECT *, 2 * (start // size) + CASE WHEN (stop - 1) // size > start // size THEN 1 ELSE 0 END AS w FROM c WHERE NOT leads),
w AS (SELECT conv_id, w, min(start) AS a0, max(lc) AS lc, max(lt) AS lt FROM n GROUP BY conv_id, w),
e AS (
  SELECT conv_id, w, body + rl + 8 + 1 + 8 AS chars, tokens FROM n
  UNION ALL SELECT w.conv_id, w.w, n.body + n.rl + 11 + 1 + 8, n.tokens FROM w JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND n.stop <= w.a0 AND w.a0 - n.start <= 128
  UNION ALL SELECT conv_id, w, lc + 11 + 1 + 8, lt FROM w WHERE lc IS NOT NULL AND a0 > 0
  UNION ALL SELECT c.conv_id, coalesce(w.w, 0), c.lc + 8 + 1 + 8, c.lt FROM c LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.a0 = 0 WHERE leads),
f AS (SELECT conv_id, w, sum(chars) AS chars, sum(tokens) > 512 AS over FROM e GROUP BY conv_id, w),
g AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars, count(*) AS n_windows, count(*) FILTER (over) AS n_over_budget FROM f GROUP BY conv_id),
h AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY k)) AS turns_sha256,
         coalesce(string_agg(t, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss FROM a GROUP BY conv_id)
SELECT h.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, n_windows, n_over_budget
FROM h JOIN g ON h.conv_id IS NOT DISTINCT FROM g.conv_id
"""
