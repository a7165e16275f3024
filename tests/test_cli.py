import json
import os

import pytest

from ledgerlink.__main__ import main
from ledgerlink.sources import fixtures, store

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables absent")


def test_cli_round_trip(spark, scratch, capsys):
    fixtures.source1(spark, SF).write.option("header", True).csv(f"{scratch}/s1")
    fixtures.source2(spark, SF).write.option("header", True).csv(f"{scratch}/s2")
    reg = f"{scratch}/registry"
    assert main(["run", "--source1", f"{scratch}/s1", "--source2", f"{scratch}/s2", "--registry", reg,
                 "--min-rows", "10", "--no-train", "--lcs-engine", "jvm"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["partitions"] > 0 and out["reconciliation"]["final_rows"] == store.read_registry(spark, reg).count()
    assert main(["export-training", "--registry", reg, "--output-parquet", f"{scratch}/train",
                 "--profit-threshold", "40000"]) == 0
    assert main(["train", "--input-parquet", f"{scratch}/train", "--model-output", f"{scratch}/model",
                 "--kind", "logistic"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()[1:]]
    assert any("auc" in x for x in lines) and any(x.get("class") == "accuracy" for x in lines)
    assert main(["predict", "--input-parquet", f"{scratch}/train", "--model-path", f"{scratch}/model",
                 "--output-parquet", f"{scratch}/preds"]) == 0
    assert main(["drift", "--predictions-parquet", f"{scratch}/preds", "--historical-avg", "0.5"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["metric"] == "prediction_rate"


def test_cli_stream(spark, scratch, capsys):
    from datetime import datetime
    from ledgerlink.operators.harmonize import harmonize_records
    from ledgerlink.operators.linkage import resolve_entities
    s1, s2 = fixtures.company_sources(spark, SF)
    harmonize_records(resolve_entities(s1, s2), datetime(2024, 1, 1)).write.parquet(f"{scratch}/in/b1")
    assert main(["stream", "--staged-dir", f"{scratch}/in/*", "--registry", f"{scratch}/reg",
                 "--checkpoint-location", f"{scratch}/ck"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == store.read_registry(spark, f"{scratch}/reg").count()
