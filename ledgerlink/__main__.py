"""Command line: ``python -m ledgerlink <command> ...`` (run under spark-submit on a cluster).

commands
  run              one registry batch from two CSV lists (quality gate .. upsert .. model)
  build-training   training parquet from a CSV
  export-training  training parquet from the registry
  train            fit a model on a training parquet, print metrics and the report
  predict          score a parquet with a saved model
  drift            prediction-rate drift of a predictions parquet
  stream           merge staged registry files arriving in a folder (Structured Streaming)
Results are printed as JSON lines.
"""

from __future__ import annotations

import argparse
import json
import sys

from ledgerlink.config import RunConfig


def _print_rows(df) -> None:
    # bounded outputs only: metrics and reports
    for row in df.collect():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerlink")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("run")
    r.add_argument("--source1", required=True)
    r.add_argument("--source2", required=True)
    r.add_argument("--registry", required=True)
    r.add_argument("--batch-id", default=RunConfig.batch_id)
    r.add_argument("--threshold", type=float, default=RunConfig.match_threshold)
    r.add_argument("--min-rows", type=int, default=RunConfig.min_rows)
    r.add_argument("--profit-threshold", type=float, default=RunConfig.profit_threshold)
    r.add_argument("--no-train", action="store_true")
    r.add_argument("--one-to-one", action="store_true", help="a list-2 name serves at most one fuzzy entity")
    r.add_argument("--match-blank", action="store_true", help="names that clean to '' link to each other")
    r.add_argument("--lcs-engine", choices=("arrow", "jvm"), default=RunConfig.lcs_engine)

    b = sub.add_parser("build-training")
    b.add_argument("--input-csv", required=True)
    b.add_argument("--output-parquet", required=True)
    b.add_argument("--profit-threshold", type=float, default=1000.0)
    b.add_argument("--min-rows", type=int, default=1)

    e = sub.add_parser("export-training")
    e.add_argument("--registry", required=True)
    e.add_argument("--output-parquet", required=True)
    e.add_argument("--profit-threshold", type=float, default=1000000.0)

    t = sub.add_parser("train")
    t.add_argument("--input-parquet", required=True)
    t.add_argument("--model-output", required=True)
    t.add_argument("--kind", choices=("forest", "logistic"), default="forest")
    t.add_argument("--test-size", type=float, default=0.2)
    t.add_argument("--metrics-root", default=None)

    s = sub.add_parser("predict")
    s.add_argument("--input-parquet", required=True)
    s.add_argument("--model-path", required=True)
    s.add_argument("--output-parquet", required=True)

    d = sub.add_parser("drift")
    d.add_argument("--predictions-parquet", required=True)
    d.add_argument("--historical-avg", type=float, required=True)
    d.add_argument("--tolerance", type=float, default=0.15)

    m = sub.add_parser("stream")
    m.add_argument("--staged-dir", required=True)
    m.add_argument("--registry", required=True)
    m.add_argument("--checkpoint-location", required=True)
    m.add_argument("--continuous", action="store_true", help="keep running (default: drain what is there)")

    a = p.parse_args(argv)

    from ledgerlink.plans import registry_run, training
    from ledgerlink.session import build_session
    spark = build_session(app_name=f"ledgerlink-{a.command}")

    if a.command == "run":
        cfg = RunConfig(batch_id=a.batch_id, match_threshold=a.threshold, min_rows=a.min_rows,
                        profit_threshold=a.profit_threshold, one_to_one=a.one_to_one, match_blank=a.match_blank,
                        lcs_engine=a.lcs_engine)
        res = registry_run.run_from_csv(spark, a.source1, a.source2, a.registry, cfg, train=not a.no_train)
        print(json.dumps({"partitions": res.partitions, "reconciliation": res.reconciliation, "drift": res.drift,
                          "model": res.model}, default=str))
    elif a.command == "build-training":
        out = training.build_training_parquet(spark, a.input_csv, a.output_parquet, a.profit_threshold, a.min_rows)
        print(json.dumps({"output": a.output_parquet, "columns": out.columns}))
    elif a.command == "export-training":
        out = training.export_training_parquet(spark, a.registry, a.output_parquet, a.profit_threshold)
        print(json.dumps({"output": a.output_parquet, "columns": out.columns}))
    elif a.command == "train":
        _, metrics, report = training.train_model(spark, a.input_parquet, a.model_output, a.kind, a.test_size,
                                                  metrics_root=a.metrics_root)
        _print_rows(metrics)
        _print_rows(report)
    elif a.command == "predict":
        out = training.predict(spark, a.input_parquet, a.model_path, a.output_parquet)
        print(json.dumps({"output": a.output_parquet, "columns": out.columns}))
    elif a.command == "drift":
        _print_rows(training.prediction_drift(spark, a.predictions_parquet, a.historical_avg, a.tolerance))
    elif a.command == "stream":
        from ledgerlink.sources import store
        from ledgerlink.streaming.incremental import start_registry_stream
        query = start_registry_stream(spark, a.staged_dir, a.registry, a.checkpoint_location,
                                      available_now=not a.continuous)
        query.awaitTermination()
        print(json.dumps({"rows": store.read_registry(spark, a.registry).count()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
