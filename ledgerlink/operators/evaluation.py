"""Exact, distributed model metrics: rank AUC and a per-class classification report."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.operators.linkage import cut_lineage


def rank_auc(df: DataFrame, score: str = "prediction_score", label: str = "label",
             buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half) as one row: auc, positives, negatives.

    AUC = sum over positives of (#negatives scored lower + 1/2 #negatives tied) / (P*N).
    The distinct scores with their counts are written once.  They are range-bucketed by approximate
    quantiles (1,024 to 65,536 cut points, one for every 50,000 scores in between), a running count over the
    bucket totals gives every bucket its offset, and a running count inside each bucket
    finishes the job: no single task sees all scores.  NULL scores are left out; NaN ranks
    highest, infinite scores rank as such.
    """
    g = cut_lineage(df.filter(F.col(score).isNotNull())
         .groupBy(F.col(score).cast("double").alias("s"))
         .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")), "scores")
    if buckets is None:
        buckets = min(max(1024, g.count() // 50_000), 65_536)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted({c for c in g.approxQuantile("s", probs, 1.0 / (4 * buckets)) if math.isfinite(c)})
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="s", outputCol="b", handleInvalid="keep").transform(g)
    totals = bucketed.groupBy("b").agg(F.sum("neg").alias("bneg"))
    offsets = totals.select("b", F.coalesce(F.sum("bneg").over(
        Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    within = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (bucketed.join(F.broadcast(offsets), "b")
              .withColumn("below", F.col("off") + F.coalesce(F.sum("neg").over(within), F.lit(0))))
    term = F.col("pos").cast("decimal(38,0)") * (F.lit(2) * F.col("below") + F.col("neg")).cast("decimal(38,0)")
    agg = ranked.agg(F.sum(term).alias("num"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  the product of two counts can pass 2^63
    denom = F.lit(2.0) * (wide("positives") * wide("negatives")).cast("double")
    return agg.select(
        F.when(denom > 0, F.col("num").cast("double") / denom).alias("auc"),
        F.col("positives").cast("long").alias("positives"), F.col("negatives").cast("long").alias("negatives"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          digits: int | None = None) -> DataFrame:
    """Rows per class plus 'accuracy', 'macro avg', 'weighted avg' with
    precision, recall, f1_score, support (zero division -> 0.0)."""
    conf = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    by_true = conf.groupBy(F.col("y").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (by_true.join(by_pred, "cls", "full_outer").na.fill(0, ["support", "tp", "predicted"])
           .withColumn("precision", F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0))
           .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)))
    per = per.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0,
                                            F.lit(2.0) * F.col("precision") * F.col("recall")
                                            / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    totals = per.agg(F.sum("support").alias("total"), F.sum("tp").alias("correct"), F.count(F.lit(1)).alias("k"),
                     F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1_score").alias("sf"),
                     F.sum(F.col("precision") * F.col("support")).alias("wp"),
                     F.sum(F.col("recall") * F.col("support")).alias("wr"),
                     F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    classes = per.select(F.col("cls").alias("class"), rnd(F.col("precision")).alias("precision"),
                         rnd(F.col("recall")).alias("recall"), rnd(F.col("f1_score")).alias("f1_score"),
                         F.col("support").cast("long").alias("support"))
    acc = totals.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                        F.lit(None).cast("double").alias("recall"),
                        rnd(F.col("correct") / F.col("total")).alias("f1_score"), F.col("total").cast("long").alias("support"))
    macro = totals.select(F.lit("macro avg").alias("class"), rnd(F.col("sp") / F.col("k")).alias("precision"),
                          rnd(F.col("sr") / F.col("k")).alias("recall"), rnd(F.col("sf") / F.col("k")).alias("f1_score"),
                          F.col("total").cast("long").alias("support"))
    weighted = totals.select(F.lit("weighted avg").alias("class"), rnd(F.col("wp") / F.col("total")).alias("precision"),
                             rnd(F.col("wr") / F.col("total")).alias("recall"),
                             rnd(F.col("wf") / F.col("total")).alias("f1_score"), F.col("total").cast("long").alias("support"))
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)
