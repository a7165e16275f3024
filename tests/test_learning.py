from pyspark.sql import functions as F

from ledgerlink.operators import learning
from ledgerlink.operators.evaluation import rank_auc
from ledgerlink.operators.reporting import drift_band, prediction_rate


def training(spark):
    rows = [(float(i), i % 3, i % 2, 1, int(i > 50), float(i * 10)) for i in range(100)]
    return spark.createDataFrame(rows, "revenue double, num_top_suppliers int, num_main_customers int, "
                                       "num_activity_places int, label int, profit double")


def test_logistic_fit_score_and_metrics(spark, scratch):
    df = training(spark)
    model = learning.fit(learning.logistic_pipeline(), df)
    preds = learning.score(model, df)
    assert {"prediction", "prediction_score"} <= set(preds.columns)
    assert preds.filter((F.col("prediction_score") < 0) | (F.col("prediction_score") > 1)).count() == 0
    auc = rank_auc(preds, "prediction_score", "label").first()["auc"]
    assert auc > 0.95
    assert abs(learning.spark_auc(preds) - auc) < 1e-9
    learning.save_model(model, f"{scratch}/model")
    again = learning.score(learning.load_model(f"{scratch}/model"), df)
    assert again.select("prediction").collect() == preds.select("prediction").collect()
    d = drift_band(prediction_rate(preds), "prediction_rate", 0.5, 0.15).first()
    assert d["is_anomaly"] is False


def test_forest(spark):
    model = learning.fit(learning.forest_pipeline(num_trees=5, max_depth=3), training(spark))
    assert learning.score(model, training(spark)).filter("prediction = label").count() > 90


def test_missing_features_and_a_single_class(spark):
    from ledgerlink.operators import learning
    rows = [(float(i), float(i), i % 3, 1, 2, 0) for i in range(40)]
    train = spark.createDataFrame(rows, "revenue double, profit double, num_top_suppliers int, num_main_customers int, num_activity_places int, label int")
    model = learning.fit(learning.forest_pipeline(num_trees=3, max_depth=2), train)
    gaps = spark.createDataFrame([(None, float("nan"), None, 1, 2, 0), (1.0, 2.0, 1, 1, 1, 1)], train.schema)
    out = learning.score(model, gaps).collect()
    assert [r["prediction"] for r in out] == [0, 0] and all(r["prediction_score"] is None or r["prediction_score"] == 0.0 for r in out)
    both = learning.fit(learning.logistic_pipeline(), train.withColumn("label", (train.revenue > 20).cast("int")))
    assert all(r["prediction_score"] == r["prediction_score"] for r in learning.score(both, gaps).collect())


def test_optimality_tells_a_fitted_model_from_others(spark):
    rows = spark.range(400).selectExpr("cast(id as double) as revenue", "cast(id % 5 as int) as num_top_suppliers", "cast(id % 3 as int) as num_main_customers",
                                       "cast(id % 7 as int) as num_activity_places", "cast((id * 7919) % 400 < id as int) as label")
    model = learning.fit(learning.logistic_pipeline(max_iter=1000, tol=1e-13), rows)
    found = learning.optimality(learning.score(model, rows)).collect()
    assert [r["coefficient"] for r in found] == ["intercept", *learning.LOGISTIC_FEATURES]
    assert all(r["residual"] < 1e-6 for r in found) and found[0]["weight"] == 400.0
    lazy = learning.score(model, rows).withColumn("prediction_score", F.lit(0.5))
    assert any(r["residual"] > 0.01 for r in learning.optimality(lazy).collect())
    other = learning.fit(learning.logistic_pipeline(), rows.filter("revenue < 150"))
    assert any(r["residual"] > 1e-3 for r in learning.optimality(learning.score(other, rows)).collect())
