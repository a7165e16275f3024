import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import RunConfig
from ledgerlink.operators.harmonize import harmonize_records
from ledgerlink.operators.linkage import resolve_entities
from ledgerlink.operators.quality import DataQualityError
from ledgerlink.plans import registry_run, training
from ledgerlink.sources import fixtures, store
from ledgerlink.streaming.incremental import start_registry_stream

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables absent")


def test_two_batches_end_to_end(spark, scratch):
    root = f"{scratch}/reg"
    cfg1 = RunConfig(batch_id="b1", min_rows=10, profit_threshold=2000.0)
    s1, s2 = fixtures.company_sources(spark, SF, "b1", "1995-06-01")
    r1 = registry_run.run_batch(spark, s1, s2, root, cfg1, datetime(2024, 1, 1))
    assert 0 < r1.partitions <= 256
    assert r1.reconciliation["final_rows"] == store.read_registry(spark, root).count()
    assert 0.0 <= r1.model["auc"] <= 1.0
    cfg2 = RunConfig(batch_id="b2", min_rows=10, profit_threshold=45000.0)
    t1, t2 = fixtures.company_sources(spark, SF, "b2")
    r2 = registry_run.run_batch(spark, t1, t2, root, cfg2, datetime(2024, 2, 1), train=False)
    assert 0 < r2.partitions <= 256
    final = store.read_registry(spark, root)
    assert final.count() == final.select("corporate_id").distinct().count()
    # the second batch sees every part, so every staged key is present with batch b2
    staged = harmonize_records(resolve_entities(t1, t2), datetime(2024, 2, 1))
    assert final.join(staged.select("corporate_id"), "corporate_id").filter("batch_id = 'b2'").count() == staged.count()
    # drift of batch 2 is judged against the history written by batch 1
    assert r2.drift["historical_avg"] == pytest.approx(r1.drift["current_value"])
    kinds = {r["kind"] for r in store.read_metrics(spark, f"{root}_runs").select("kind").distinct().collect()}
    assert kinds == {"parameters", "reconciliation", "drift", "model"}


def test_quality_gate_stops_the_run(spark, scratch):
    s1, s2 = fixtures.company_sources(spark, SF)
    with pytest.raises(DataQualityError):
        registry_run.run_batch(spark, s1, s2, f"{scratch}/reg", RunConfig(min_rows=10**6), train=False)
    assert not store.registry_exists(spark, f"{scratch}/reg")


def test_training_flow(spark, scratch):
    csv = f"{scratch}/in.csv"
    rows = ["company_id,revenue,profit,top_suppliers,main_customers,activity_places"]
    rows += [f'{i},{1000 + 37 * i},{(i * 53) % 2000 - 100},"s{i % 3}|s{i % 5}","c{i % 4}","x|y"' for i in range(200)]
    with open(csv, "w") as f:
        f.write("\n".join(rows) + "\n")
    tp = training.build_training_parquet(spark, csv, f"{scratch}/train.parquet", profit_threshold=1000.0)
    assert tp.count() == 200
    model, metrics, report = training.train_model(spark, f"{scratch}/train.parquet", f"{scratch}/model",
                                                  kind="logistic", metrics_root=f"{scratch}/metrics")
    m = metrics.first()
    assert m["train_count"] + m["test_count"] == 200 and m["rows"] == 200
    assert {r["class"] for r in report.collect()} >= {"accuracy", "macro avg", "weighted avg"}
    preds = training.predict(spark, f"{scratch}/train.parquet", f"{scratch}/model", f"{scratch}/preds")
    assert {"prediction", "prediction_score"} <= set(preds.columns) and preds.count() == 200
    d = training.prediction_drift(spark, f"{scratch}/preds", 0.5, 0.15).first()
    assert d["metric"] == "prediction_rate"
    recorded = {r["name"]: r for r in store.read_metrics(spark, f"{scratch}/metrics").collect()}
    assert recorded["rows"]["value"] == 200 and "revenue" in recorded["features"]["text"] and "precision" in recorded["report:macro avg"]["text"]


def test_equal_training_rows_split_by_number(spark, scratch):
    rows = [(5.0, 1.0, 1, 1, 1, 0)] * 300 + [(float(i), 2.0, 2, 1, 1, i % 2) for i in range(300)]
    spark.createDataFrame(rows, "revenue double, profit double, num_top_suppliers int, num_main_customers int, num_activity_places int, label int") \
        .write.parquet(f"{scratch}/train.parquet")
    _, metrics, _ = training.train_model(spark, f"{scratch}/train.parquet", f"{scratch}/model", kind="logistic")
    m = metrics.first()
    assert (m["test_count"], m["train_count"]) == (90 + 30, 360 + 120)


def test_export_from_registry(spark, scratch):
    root = f"{scratch}/reg"
    s1, s2 = fixtures.company_sources(spark, SF)
    store.upsert_registry(spark, root, harmonize_records(resolve_entities(s1, s2), datetime(2024, 1, 1)))
    out = training.export_training_parquet(spark, root, f"{scratch}/export", 45000.0)
    assert out.columns[0] == "corporate_id" and out.count() == store.read_registry(spark, root).count()


def test_streaming_upserts_exactly_once(spark, scratch):
    s1, s2 = fixtures.company_sources(spark, SF)
    reg = harmonize_records(resolve_entities(s1, s2), datetime(2024, 1, 1))
    incoming = f"{scratch}/incoming"
    reg.filter(F.col("match_type") != "source2_only").write.parquet(f"{incoming}/part1")
    root, ckpt = f"{scratch}/reg", f"{scratch}/ckpt"
    q = start_registry_stream(spark, f"{incoming}/*", root, ckpt)
    q.awaitTermination()
    first = store.read_registry(spark, root).count()
    reg.filter(F.col("match_type") == "source2_only").write.parquet(f"{incoming}/part2")
    q = start_registry_stream(spark, f"{incoming}/*", root, ckpt)
    q.awaitTermination()
    assert store.read_registry(spark, root).count() == reg.count() > first
