"""Spark ML training and batch scoring (distributed; no single-machine hop)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.schemas import require_columns

# Feature sets of the two models.
LOGISTIC_FEATURES = ("revenue", "num_top_suppliers", "num_main_customers", "num_activity_places")
FOREST_FEATURES = ("revenue", "profit", "num_top_suppliers", "num_main_customers", "num_activity_places")


def logistic_pipeline(features: Sequence[str] = LOGISTIC_FEATURES, label: str = "label", max_iter: int = 100, tol: float = 1e-6) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, tol=tol),
    ])


def forest_pipeline(features: Sequence[str] = FOREST_FEATURES, label: str = "label", num_trees: int = 200,
                    max_depth: int = 6, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, seed=seed),
    ])


def _filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN features as 0, as the training sets have them."""
    return df.na.fill(0.0, list(columns))


def fit(pipeline: Pipeline, train: DataFrame, label: str = "label") -> PipelineModel:
    stages = pipeline.getStages()
    require_columns(train, [*stages[0].getInputCols(), label], "training set")
    return pipeline.fit(_filled(train, stages[0].getInputCols()).withColumn(label, F.col(label).cast("double")))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (int) and ``prediction_score`` = P(class 1); NULL where the model knows one class only."""
    require_columns(df, model.stages[0].getInputCols(), "scoring input")
    out = model.transform(_filled(df, model.stages[0].getInputCols()))
    return (out.withColumn("prediction", F.col("prediction").cast("int"))
            .withColumn("prediction_score", F.get(vector_to_array("probability"), F.lit(1)))
            .drop("features", "rawPrediction", "probability"))


def optimality(scored: DataFrame, features: Sequence[str] = LOGISTIC_FEATURES, label: str = "label") -> DataFrame:
    """(coefficient, weight, residual) for the intercept and each feature over scored training rows: sum(|x|), and |sum((p - y) x)| / sum(|x|).

    At the maximum of the likelihood every residual is zero; a model that wasn't fitted to these rows has others.  One aggregate."""
    error = F.col("prediction_score") - F.col(label)
    terms = {"intercept": F.lit(1.0), **{c: F.col(c).cast("double") for c in features}}
    sums = scored.agg(*[x for c, v in terms.items() for x in (F.sum(F.abs(v)).alias(f"w_{c}"), F.abs(F.sum(error * v)).alias(f"r_{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("coefficient"), F.col(f"w_{c}").alias("weight"), (F.col(f"r_{c}") / F.col(f"w_{c}")).alias("residual")) for c in terms])
    return sums.select(F.explode(rows).alias("x")).select("x.*")


def spark_auc(predictions: DataFrame, label: str = "label") -> float:
    """Spark ML's evaluator without binning (numBins=0 means exact)."""
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="prediction_score", numBins=0)
    return float(evaluator.evaluate(predictions.withColumn(label, F.col(label).cast("double"))))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
