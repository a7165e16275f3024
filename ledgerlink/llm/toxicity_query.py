"""Query of the toxicity score (a learnt model: tests measure its held-out accuracy and hold the automata against brute force)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import toxicity as op
from ledgerlink.llm.frames import table

FOLDS = 5


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda c: F.crc32(F.col(c).cast("string")) % FOLDS
    terms, weights = op.learn(docs, labels.filter(fold("doc_id") != 0))
    return op.score(docs, terms, weights).select(
        F.col("id").alias("doc_id"), F.coalesce(fold("id") == 0, F.lit(False)).alias("held_out"), "score", "predicted", "n_terms", "n_misspelled", "n_quoted")
