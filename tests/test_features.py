import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators.evaluation import classification_report, rank_auc
from ledgerlink.operators.features import (
    add_ml_features, hash_split, split_counts, stratified_split, training_export, training_from_source,
)
from ledgerlink.operators.quality import DataQualityError
from ledgerlink.schemas import ContractError


def test_counts_and_label_at_the_threshold(spark):
    # profits just below, at and just above the threshold; lists of 0 to 4 items, one with a repeat
    df = spark.createDataFrame([
        ("p", "Quay Foundry", "", "Dune", "Kelp Bros|Moss|Fern|Moss", 12.5, 749.99),
        ("q", "Tarn Mills", "Oslo|Bergen|Hamar", "Dune|Reed", "Kelp Bros", 0.0, 750.0),
        ("r", "Heath Glass", "Oslo", "", "", 3.0, 750.01),
    ], ["corporate_id", "canonical_name", "activity_places", "top_suppliers", "main_customers", "revenue", "profit"])
    got = [(r["num_activity_places"], r["num_top_suppliers"], r["num_main_customers"], r["label"])
           for r in add_ml_features(df, 750).orderBy("corporate_id").collect()]
    assert got == [(0, 1, 4, 0), (3, 2, 1, 0), (1, 0, 0, 1)]


def test_unreadable_money_counts_as_missing(spark):
    df = spark.createDataFrame([("n/a", "12", "a|b"), ("7", "x", None), ("-", None, "")], "revenue string, profit string, main_customers string")
    rows = sorted(tuple(r) for r in training_from_source(df, 10.0, min_rows=1).collect())
    assert rows == [(0.0, 0.0, 0, 0, 0, 0), (0.0, 12.0, 0, 2, 0, 1), (7.0, 0.0, 0, 0, 0, 0)]


def test_auc_with_infinite_nan_and_missing_scores(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf, 0), (-inf, 1), (0.5, 0), (inf, 1), (inf, 0), (float("nan"), 1), (None, 1)], "score double, label int")
    r = rank_auc(df, "score", "label").first()
    # three positives against three negatives: 1/2 + 0 + 0, 1 + 1 + 1/2, 3
    assert (r["positives"], r["negatives"]) == (3, 3) and abs(r["auc"] - 6 / 9) < 1e-12


def test_list_count_modes_and_fill(spark):
    df = spark.createDataFrame([("", None, "a||b", float("nan"), None)],
                               "top_suppliers string, main_customers string, activity_places string, revenue double, profit double")
    parsed = add_ml_features(df, 0.0).first()
    assert (parsed["num_top_suppliers"], parsed["num_main_customers"], parsed["num_activity_places"]) == (0, 0, 2)
    assert parsed["revenue"] == 0.0 and parsed["profit"] == 0.0 and parsed["label"] == 0
    compat = add_ml_features(df, 0.0, "compat").first()
    assert (compat["num_top_suppliers"], compat["num_main_customers"], compat["num_activity_places"]) == (1, -1, 3)


def test_training_export_contract_and_columns(spark):
    reg = spark.createDataFrame([("k", None, "a|b", "", None, "12.5")],
                                "corporate_id string, top_suppliers string, main_customers string, activity_places string, revenue double, profit string")
    out = training_export(reg, 10.0)
    assert out.columns[0] == "corporate_id" and "label" in out.columns and "address" not in out.columns
    r = out.first()
    assert (r["revenue"], r["profit"], r["label"], r["num_main_customers"]) == (0.0, 12.5, 1, 2)
    with pytest.raises(ContractError):
        training_export(reg.drop("profit"))


def test_training_from_csv(spark, scratch):
    path = f"{scratch}/train.csv"
    with open(path, "w") as f:
        f.write("company_id,revenue,profit,top_suppliers,main_customers,activity_places\n"
                '1,9000,1200,"s1|s2","c1|c2|c3","x|y"\n2,3000,100,"s1","c1","x"\n4,1200,-40,"","c1","y"\n')
    from ledgerlink.sources.companies import read_csv_inferred
    raw = read_csv_inferred(spark, path)
    out = training_from_source(raw, 1000.0, min_rows=1)
    assert out.columns == ["revenue", "profit", "num_top_suppliers", "num_main_customers", "num_activity_places", "label"]
    rows = {r["revenue"]: r for r in out.collect()}
    assert rows[9000]["label"] == 1 and rows[1200]["num_top_suppliers"] == 0
    with pytest.raises(DataQualityError):
        training_from_source(raw, 1000.0, min_rows=4)


def test_splits(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("corporate_id"),
                                  (F.col("id") % 10 < 3).cast("int").alias("label"))
    hs = hash_split(df)
    again = {r["corporate_id"]: r["split"] for r in hash_split(df.repartition(5)).collect()}
    assert {r["corporate_id"]: r["split"] for r in hs.collect()} == again
    c = split_counts(hs).first()
    assert c["train_count"] + c["test_count"] == 1000 and 740 < c["train_count"] < 860
    st = stratified_split(df).groupBy("label", "split").count().collect()
    got = {(r["label"], r["split"]): r["count"] for r in st}
    assert got[(0, "test")] == math.ceil(0.2 * 700) and got[(1, "test")] == math.ceil(0.2 * 300)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y != 1]
    win = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return win / (len(pos) * len(neg))


def test_rank_auc_exact_with_ties(spark):
    rng = random.Random(5)
    pairs = [(float(rng.randint(0, 40)), int(rng.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "score double, label int")
    r = rank_auc(df, "score", "label", buckets=8).first()
    assert abs(r["auc"] - brute_auc(pairs)) < 1e-12
    assert r["positives"] + r["negatives"] == 600


def test_classification_report(spark):
    yp = [(1, 1)] * 30 + [(1, 0)] * 10 + [(0, 0)] * 50 + [(0, 1)] * 10
    rep = {r["class"]: r for r in classification_report(spark.createDataFrame(yp, "label int, prediction int")).collect()}
    assert rep["1"]["precision"] == 30 / 40 and rep["1"]["recall"] == 30 / 40 and rep["1"]["support"] == 40
    assert rep["0"]["precision"] == 50 / 60 and rep["0"]["recall"] == 50 / 60
    assert rep["accuracy"]["f1_score"] == 80 / 100
    assert abs(rep["macro avg"]["f1_score"] - (0.75 + 50 / 60) / 2) < 1e-12
    assert abs(rep["weighted avg"]["recall"] - 0.8) < 1e-12
