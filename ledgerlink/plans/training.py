"""Training-set builds, model training, batch scoring and prediction drift as Spark jobs
(one lineage from files to metrics; no hop to a single-machine library)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.operators import evaluation, features, learning, reporting
from ledgerlink.schemas import require_columns
from ledgerlink.sources import companies, store


def build_training_parquet(spark: SparkSession, input_csv: str, output: str, profit_threshold: float = 1000.0,
                           min_rows: int = 1, name_column: str | None = None) -> DataFrame:
    """CSV (schema inferred) -> quality gate -> defaults -> features -> six columns -> parquet."""
    raw = companies.read_csv_inferred(spark, input_csv)
    out = features.training_from_source(raw, profit_threshold, min_rows, name_column)
    out.write.mode("overwrite").parquet(output)
    return spark.read.parquet(output)


def export_training_parquet(spark: SparkSession, registry: str, output: str,
                            profit_threshold: float = 1000000.0) -> DataFrame:
    """Registry (table name or folder) -> contract -> null normalisation -> features -> parquet."""
    features.training_export(store.read_registry(spark, registry), profit_threshold).write.mode("overwrite").parquet(output)
    return spark.read.parquet(output)


def train_model(spark: SparkSession, input_parquet: str, model_output: str, kind: str = "forest",
                test_fraction: float = 0.2, key: str | None = None, metrics_root: str | None = None,
                run_id: str = "train"):
    """Stratified split (exact per-label counts), fit, evaluate.  Returns (model, metrics,
    classification report).  Rows without a key column get a number of their own, written once
    with them, so that equal rows (which such sets are full of) don't share a key."""
    df = spark.read.parquet(input_parquet)
    require_columns(df, [*learning.FOREST_FEATURES, "label"], "training set")
    if key is None:
        key = "_row_key"
        df = store.stage(df.withColumn(key, F.monotonically_increasing_id().cast("string")), "training")
    split = features.stratified_split(df, "label", key, test_fraction)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    pipeline = learning.forest_pipeline() if kind == "forest" else learning.logistic_pipeline()
    model = learning.fit(pipeline, train)
    preds = learning.score(model, test)
    learning.save_model(model, model_output)
    auc = evaluation.rank_auc(preds, "prediction_score", "label")
    counts = features.split_counts(split)
    metrics = reporting.combine_single_rows(auc, counts, df.agg(F.count(F.lit(1)).alias("rows")))
    report = evaluation.classification_report(preds, "label", "prediction")
    if metrics_root:
        m = metrics.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in ("auc", "train_count", "test_count", "rows")])).alias("m")).select("m.*", F.lit(None).cast("string").alias("text"))
        per_class = report.select(F.concat(F.lit("report:"), "class").alias("name"), F.col("f1_score").alias("value"),
                                  F.to_json(F.struct("precision", "recall", "f1_score", "support")).alias("text"))
        chosen = spark.createDataFrame([("features", ",".join(pipeline.getStages()[0].getInputCols())), ("test_fraction", str(test_fraction))],
                                       "name string, text string").select("name", F.lit(None).cast("double").alias("value"), "text")
        m = m.unionByName(per_class).unionByName(chosen)
        store.append_metrics(spark, metrics_root, m.select(F.lit(run_id).alias("run_id"), F.lit("").alias("batch_id"),
                                                           F.lit(f"model:{kind}").alias("kind"), "name", "value", "text",
                                                           F.current_timestamp().alias("recorded_at")))
    return model, metrics, report


def predict(spark: SparkSession, input_parquet: str, model_path: str, output: str) -> DataFrame:
    """Batch scoring: every input row plus prediction and P(class 1), written as parquet."""
    model = learning.load_model(model_path)
    learning.score(model, spark.read.parquet(input_parquet)).write.mode("overwrite").parquet(output)
    return spark.read.parquet(output)


def prediction_drift(spark: SparkSession, predictions_parquet: str, historical_avg: float,
                     tolerance: float = 0.15) -> DataFrame:
    preds = spark.read.parquet(predictions_parquet)
    require_columns(preds, ["prediction"], "predictions")
    return reporting.drift_band(reporting.prediction_rate(preds), "prediction_rate", historical_avg, tolerance)
