"""One registry batch, end to end.

quality gate -> resolve -> harmonise -> stage (lineage cut) -> keyed upsert ->
reconciliation + drift (against the metric history) -> features -> model -> metrics.

Every step is a Spark job over the whole inputs; what comes back to the driver is
bounded: the quality report (one row per rule), one reconciliation row, one drift row and
a few model metrics.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.config import RunConfig
from ledgerlink.operators import evaluation, features, learning, linkage, quality, reporting
from ledgerlink.operators.harmonize import harmonize_records
from ledgerlink.session import checkpoint_root
from ledgerlink.sources import companies, store


@dataclass
class BatchResult:
    run_id: str
    partitions: int  # rewritten by the upsert
    quality: list = field(default_factory=list)
    reconciliation: dict = field(default_factory=dict)
    drift: dict = field(default_factory=dict)
    model: dict = field(default_factory=dict)


def _metric_rows(spark: SparkSession, run_id: str, batch_id: str, kind: str, values: dict) -> DataFrame:
    rows = [(run_id, batch_id, kind, k, float(v)) for k, v in values.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)]
    rows = [(*r, None) for r in rows] + [(run_id, batch_id, kind, k, None, str(v)) for k, v in values.items()
                                         if isinstance(v, (str, bool, list, tuple))]
    df = spark.createDataFrame(rows, "run_id string, batch_id string, kind string, name string, value double, text string")
    return df.withColumn("recorded_at", F.current_timestamp())


def run_batch(spark: SparkSession, source1: DataFrame, source2: DataFrame, registry: str,
              config: RunConfig = RunConfig(), run_ts: datetime | None = None, train: bool = True,
              use_history: bool = True, metrics_root: str | None = None) -> BatchResult:
    """``registry`` names a table or a folder; metrics and models go below ``metrics_root`` (default:
    next to the folder, or the checkpoint folder's ``<table>`` for a table)."""
    if metrics_root is None:
        metrics_root = f"{registry.rstrip('/')}_runs" if "/" in registry else f"{checkpoint_root(spark)}/{registry}_runs"
    run_id = uuid.uuid4().hex
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)

    # 1. circuit breaker: both suites, one aggregate pass each, fail before any linking
    report = quality.source1_report(source1, config.min_rows).unionByName(
        quality.source2_report(source2, config.min_rows, spread_factor=config.revenue_spread_factor))
    checked = quality.enforce(report)

    # 2-4. resolve, harmonise, stage once: merge, counts and drift all read the staged copy
    entities = linkage.resolve_entities(source1, source2, config.match_threshold, config.block_chars,
                                        match_blank=config.match_blank, one_to_one=config.one_to_one,
                                        pairs_per_task=config.pairs_per_task, lcs_engine=config.lcs_engine)
    staged, folder = store.stage_at(harmonize_records(entities, run_ts), "staging")

    # 5. MERGE into the partitions that the batch touches
    partitions = store.upsert_registry(spark, registry, staged)
    final = store.read_registry(spark, registry)

    # 6. reconciliation and drift
    recon = reporting.reconciliation_report(source1, source2, final).first().asDict()
    ratio = reporting.consolidation_ratio(source1, source2, staged)
    history = store.read_metrics(spark, metrics_root) if use_history else None
    if history is not None:
        drift_df = reporting.drift_against_history(ratio, history, "consolidation_ratio", config.drift_tolerance,
                                                   config.drift_historical_avg)
    else:
        drift_df = reporting.drift_band(ratio, "consolidation_ratio", config.drift_historical_avg,
                                        config.drift_tolerance)
    drift = drift_df.first().asDict()
    result = BatchResult(run_id, partitions, [r.asDict() for r in checked], recon, drift)
    metrics = [_metric_rows(spark, run_id, config.batch_id, "parameters", asdict(config)),
               _metric_rows(spark, run_id, config.batch_id, "reconciliation", recon),
               _metric_rows(spark, run_id, config.batch_id, "drift", {"consolidation_ratio": drift["current_value"]})]

    # 7. model on the curated registry
    if train:
        model, model_metrics = train_and_evaluate(features.add_ml_features(final, config.profit_threshold))
        learning.save_model(model, f"{metrics_root}/models/{run_id}")
        result.model = model_metrics
        metrics.append(_metric_rows(spark, run_id, config.batch_id, "model", model_metrics))

    out = metrics[0]
    for m in metrics[1:]:
        out = out.unionByName(m)
    store.append_metrics(spark, metrics_root, out)
    store.remove_folder(spark, folder)
    return result


def train_and_evaluate(featured: DataFrame, kind: str = "logistic", key: str = "corporate_id"):
    """Hash split 80/20 on the key, fit, score the test part; exact AUC and counts."""
    split = features.hash_split(featured, key)
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    pipeline = learning.logistic_pipeline() if kind == "logistic" else learning.forest_pipeline()
    model = learning.fit(pipeline, train)
    preds = learning.score(model, test)
    auc = evaluation.rank_auc(preds, "prediction_score", "label").first()
    counts = features.split_counts(split).first()
    return model, {"kind": kind, "features": list(pipeline.getStages()[0].getInputCols()), "auc": auc["auc"], "train_count": counts["train_count"], "test_count": counts["test_count"]}


def run_from_csv(spark: SparkSession, source1_path: str, source2_path: str, registry: str,
                 config: RunConfig = RunConfig(), **kwargs) -> BatchResult:
    s1 = companies.read_source1(spark, source1_path, config.batch_id)
    s2 = companies.read_source2(spark, source2_path, config.batch_id)
    return run_batch(spark, s1, s2, registry, config, **kwargs)
