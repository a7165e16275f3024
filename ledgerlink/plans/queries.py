"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole
TPC-H-derived company lists.  Timestamps (ingestion/run time) are left out of outputs
so results are reproducible; everything else is the operator's full output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.config import RunConfig
from ledgerlink.functions.text import block_key, clean_name, normalize_address, parse_list
from ledgerlink.operators import evaluation, features, learning, linkage, matching, quality, reporting, succession, upsert
from ledgerlink.operators.harmonize import harmonize_records
from ledgerlink.plans import incremental
from ledgerlink.schemas import REGISTRY_COLUMNS
from ledgerlink.session import checkpoint_root, delete_on_exit
from ledgerlink.sources import bucketed, companies, fixtures, store

# Fixed parameters of the registered runs.
THRESHOLD = 85.0
ONE_TO_ONE_THRESHOLD = 50.0        # low, so that names compete for partners
PROFIT_THRESHOLD = 45000.0        # balanced labels on the derived lists
FIRST_BATCH_CUTOFF = "1995-03-01"  # batch 1 = the lists as of this ship date
INCREMENT_CUTOFF = "1992-05-01"    # a first batch that lacks some companies
INCREMENT_PARTS = 16               # partitions of the state, for lists of this size
FIT_ITERATIONS, FIT_TOLERANCE = 1000, 1e-13  # the fit runs to its optimum, which is unique
RULE_REVENUE_CUTOFF = 1000000.0    # deterministic rule classifier for metric checks
RUN_TS = datetime(2024, 1, 1)
NO_TS = [c for c in REGISTRY_COLUMNS if c != "last_updated_ts"]


def _sources(spark: SparkSession, sf: str, batch: str = "batch_001", cutoff: str | None = None):
    return fixtures.company_sources(spark, sf, batch, cutoff)


def _written_sources(spark: SparkSession, sf: str):
    """Both lists for a query that reads them more than once: made and written once."""
    return [store.stage(rows, "source") for rows in _sources(spark, sf)]


def _entities(spark: SparkSession, sf: str, batch: str = "batch_001", cutoff: str | None = None) -> DataFrame:
    s1, s2 = _sources(spark, sf, batch, cutoff)
    return linkage.resolve_entities(s1, s2, THRESHOLD)


def _registry(spark: SparkSession, sf: str, batch: str = "batch_001", cutoff: str | None = None) -> DataFrame:
    return harmonize_records(_entities(spark, sf, batch, cutoff), RUN_TS)


def _scratch(spark: SparkSession, what: str) -> str:
    path = f"{checkpoint_root(spark)}/ledgerlink-{what}/{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


# ---------------------------------------------------------------- sources

def q_source1_scan(spark, sf):
    """Fixture written as header CSV to the shared folder (columns in another order, and one more), read back by the source-1 scan."""
    path = _scratch(spark, "csv")
    rows = fixtures.source1(spark, sf).withColumn("country", F.lit("n/a"))
    rows.select("country", "top_suppliers", "corporate_name_s1", "activity_places", "address").write.option("header", True).csv(path)
    return companies.read_source1(spark, path, "batch_001").drop("ingestion_ts")


def q_source2_scan(spark, sf):
    path = _scratch(spark, "csv")
    rows = fixtures.source2(spark, sf).withColumn("company_id", F.lit(7))
    rows.select("company_id", "profit", "main_customers", "corporate_name_s2", "revenue").write.option("header", True).csv(path)
    return companies.read_source2(spark, path, "batch_001").drop("ingestion_ts")


# ---------------------------------------------------------------- expressions

def _names(spark, sf):
    s1, s2 = _sources(spark, sf)
    return (s1.select(F.lit("source1").alias("source"), F.col("corporate_name_s1").alias("raw_name"))
            .unionByName(s2.select(F.lit("source2").alias("source"), F.col("corporate_name_s2").alias("raw_name"))))


def q_clean_names(spark, sf):
    return _names(spark, sf).withColumn("clean_name", clean_name("raw_name"))


def q_block_keys(spark, sf):
    return (_names(spark, sf).withColumn("clean_name", clean_name("raw_name"))
            .withColumn("block", block_key("clean_name", 6)))


def q_clean_addresses(spark, sf):
    s1, _ = _sources(spark, sf)
    return s1.select("address", normalize_address("address").alias("clean_address"))


def q_parse_lists(spark, sf):
    s1, s2 = _sources(spark, sf)
    lists = (s1.select(F.lit("top_suppliers").alias("field"), F.col("top_suppliers").alias("raw_list"))
             .unionByName(s1.select(F.lit("activity_places").alias("field"), F.col("activity_places").alias("raw_list")))
             .unionByName(s2.select(F.lit("main_customers").alias("field"), F.col("main_customers").alias("raw_list"))))
    return lists.select("field", "raw_list", F.array_join(parse_list("raw_list"), "|").alias("items"),
                        F.size(parse_list("raw_list")).alias("n_items"))


# ---------------------------------------------------------------- linkage steps

def _groups(spark, sf):
    s1, s2 = _sources(spark, sf)
    g1, g2 = (linkage.cut_lineage(linkage.collapse_side(linkage.prepare_source1(s1), "s1"), "side1"),
              linkage.cut_lineage(linkage.collapse_side(linkage.prepare_source2(s2), "s2"), "side2"))
    return linkage.named(g1, "s1"), linkage.named(g2, "s2")


def q_exact_match(spark, sf):
    n1, n2 = _groups(spark, sf)
    return linkage.exact_links(n1, n2).select("clean_name_s1", "corporate_name_s1", "corporate_name_s2",
                                              "revenue", "match_type", "match_confidence")


def q_unmatched_source1(spark, sf):
    n1, n2 = _groups(spark, sf)
    return linkage.unlinked_s1(n1, n2).select("clean_name_s1", "corporate_name_s1", "row_id_s1", "n_rows_s1")


def q_unmatched_source2(spark, sf):
    n1, n2 = _groups(spark, sf)
    return linkage.unlinked_s2(n2, n1).select("clean_name_s2", "corporate_name_s2", "row_id_s2", "n_rows_s2")


def q_token_sort_scores(spark, sf):
    """Every blocked candidate pair that reaches the threshold, with its score."""
    n1, n2 = _groups(spark, sf)
    pairs = linkage.pruned_pairs(linkage.unlinked_s1(n1, n2), linkage.unlinked_s2(n2, n1), THRESHOLD)
    return linkage.score_pairs(pairs).select("clean_name_s1", "clean_name_s2", "name_score").filter(F.col("name_score") >= THRESHOLD)


def q_fuzzy_match(spark, sf):
    n1, n2 = _groups(spark, sf)
    return linkage.fuzzy_links(linkage.unlinked_s1(n1, n2), linkage.unlinked_s2(n2, n1), THRESHOLD) \
        .select("clean_name_s1", "clean_name_s2", "name_score", "match_type", "match_confidence")


def q_pair_pruning(spark, sf):
    """Per block: the pairs it holds, those that are scored and those that reach the threshold."""
    n1, n2 = _groups(spark, sf)
    return linkage.pruning_statistics(linkage.unlinked_s1(n1, n2), linkage.unlinked_s2(n2, n1), THRESHOLD)


def q_one_to_one_matches(spark, sf):
    """The stable matching of all pairs that reach the threshold."""
    n1, n2 = _groups(spark, sf)
    pairs = linkage.pruned_pairs(linkage.unlinked_s1(n1, n2), linkage.unlinked_s2(n2, n1), ONE_TO_ONE_THRESHOLD)
    return matching.stable_partners(linkage.score_pairs(pairs), ONE_TO_ONE_THRESHOLD)


def q_source1_only(spark, sf):
    return _entities(spark, sf).filter(F.col("match_type") == "source1_only") \
        .select("corporate_id", "canonical_name", "match_confidence")


def q_source2_only(spark, sf):
    return _entities(spark, sf).filter(F.col("match_type") == "source2_only") \
        .select("corporate_id", "canonical_name", "match_confidence")


def q_resolve_entities(spark, sf):
    return _entities(spark, sf).select(
        "corporate_id", "canonical_name", "match_type", "match_confidence", "clean_name_s1", "clean_name_s2",
        "row_id_s1", "row_id_s2", "n_rows_s1", "n_rows_s2", "clean_address_s1", "revenue", "profit")


def q_incremental_entities(spark, sf):
    """A first batch as of an early ship date, then the rows whose names it didn't have; the entities of the state."""
    state = _scratch(spark, "state")
    first, every = ([store.stage(rows) for rows in _sources(spark, sf, *batch)] for batch in (("batch_001", INCREMENT_CUTOFF), ("batch_002",)))
    incremental.resolve_batch(spark, state, *first, "batch_001", THRESHOLD, parts=INCREMENT_PARTS)
    later = [rows.withColumn("_name", clean_name(c)).join(known.select(clean_name(c).alias("_name")), "_name", "left_anti").drop("_name")
             for rows, known, c in zip(every, first, ("corporate_name_s1", "corporate_name_s2"), strict=True)]
    incremental.resolve_batch(spark, state, *later, "batch_002", THRESHOLD, parts=INCREMENT_PARTS)
    return incremental.read_entities(spark, state).select(
        "corporate_id", "canonical_name", "match_type", "match_confidence", "clean_name_s1", "clean_name_s2",
        "row_id_s1", "row_id_s2", "n_rows_s1", "n_rows_s2", "clean_address_s1", "revenue", "profit", "batch_id_s1", "batch_id_s2")


def q_harmonized_registry(spark, sf):
    return _registry(spark, sf).select(*NO_TS)


def q_link_rows(spark, sf):
    s1, s2 = _written_sources(spark, sf)
    return linkage.link_rows(s1, s2, linkage.resolve_entities(s1, s2, THRESHOLD))


def q_duplicate_keys(spark, sf):
    """Registry keys carried by more than one input row (consolidated entities)."""
    s1, s2 = _written_sources(spark, sf)
    rows = linkage.link_rows(s1, s2, linkage.resolve_entities(s1, s2, THRESHOLD))
    return upsert.duplicate_keys(rows)


# ---------------------------------------------------------------- upsert

def _batches(spark, sf):
    target = _registry(spark, sf, "batch_001", FIRST_BATCH_CUTOFF)
    staged = _registry(spark, sf, "batch_002", None)
    return target, staged


def q_upsert_registry(spark, sf):
    target, staged = _batches(spark, sf)
    return upsert.merge_upsert(target, staged).select(*NO_TS)


def q_upsert_partial_columns(spark, sf):
    target, staged = _batches(spark, sf)
    return upsert.merge_upsert_legacy(target, staged).select(*NO_TS)


def q_stale_registry_rows(spark, sf):
    """After merging batch 2 into batch 1: rows batch 2 did not produce again."""
    target, staged = _batches(spark, sf)
    return upsert.stale_rows(upsert.merge_upsert(target, staged), staged).select(*NO_TS)


def q_entity_succession(spark, sf):
    """What became of the keys of batch 1 that batch 2 did not produce again."""
    return succession.entity_succession(_entities(spark, sf, "batch_001", FIRST_BATCH_CUTOFF), _entities(spark, sf, "batch_002"))


def q_upsert_actions(spark, sf):
    target, staged = _batches(spark, sf)
    return upsert.upsert_actions(target, staged)


def q_registry_store(spark, sf):
    """Both batches merged into a partitioned registry, one after the other, and read from it."""
    registry = _scratch(spark, "registry")
    target, staged = _batches(spark, sf)
    store.upsert_registry(spark, registry, store.stage(target))
    store.upsert_registry(spark, registry, store.stage(staged))
    return store.read_registry(spark, registry).select(*NO_TS)


def q_registry_bucketed(spark, sf):
    """Both batches merged into a bucketed registry, one after the other, and read from it."""
    folder, registry = _scratch(spark, "bucketed"), f"ledgerlink_{uuid.uuid4().hex}"
    target, staged = _batches(spark, sf)
    bucketed.upsert_bucketed(spark, registry, target, folder=folder)
    bucketed.upsert_bucketed(spark, registry, staged, folder=folder)
    return bucketed.read_bucketed(spark, registry).select(*NO_TS)


# ---------------------------------------------------------------- quality

def q_quality_source1(spark, sf):
    s1, _ = _sources(spark, sf)
    return quality.source1_report(s1, RunConfig().min_rows)


def q_quality_source2(spark, sf):
    _, s2 = _sources(spark, sf)
    return quality.source2_report(s2, RunConfig().min_rows)


def q_quality_customer(spark, sf):
    """The finance suite over the customer table (account balance as revenue)."""
    c = fixtures.table(spark, sf, "customer").select(F.col("c_name").alias("corporate_name_s2"),
                                                     F.col("c_acctbal").alias("revenue"))
    return quality.source2_report(c, RunConfig().min_rows)


# ---------------------------------------------------------------- reports

def q_match_type_counts(spark, sf):
    return reporting.match_type_counts(_registry(spark, sf))


def q_reconciliation(spark, sf):
    s1, s2 = _written_sources(spark, sf)
    return reporting.reconciliation_report(s1, s2, harmonize_records(linkage.resolve_entities(s1, s2, THRESHOLD), RUN_TS))


def q_registry_view_counts(spark, sf):
    """The registry as a temporary view, queried with SQL (per link kind: rows, presence, score range)."""
    _registry(spark, sf).createOrReplaceTempView("ledgerlink_registry")
    return spark.sql("""
        SELECT match_type, count(*) AS rows,
               count_if(source1_present AND source2_present) AS both_sources,
               min(match_confidence) AS min_confidence, max(match_confidence) AS max_confidence
        FROM ledgerlink_registry GROUP BY match_type""")


def q_block_stats(spark, sf):
    s1, s2 = _sources(spark, sf)
    return linkage.block_statistics(s1, s2)


def q_consolidation_drift(spark, sf):
    s1, s2 = _written_sources(spark, sf)
    cfg = RunConfig()
    staged = harmonize_records(linkage.resolve_entities(s1, s2, THRESHOLD), RUN_TS)
    return reporting.drift_band(reporting.consolidation_ratio(s1, s2, staged), "consolidation_ratio",
                                cfg.drift_historical_avg, cfg.drift_tolerance)


# ---------------------------------------------------------------- features

def _features(spark, sf, mode="parsed"):
    return features.add_ml_features(_registry(spark, sf), PROFIT_THRESHOLD, mode).select(
        "corporate_id", "revenue", "profit", "num_top_suppliers", "num_main_customers", "num_activity_places", "label")


def q_ml_features(spark, sf):
    return _features(spark, sf)


def q_ml_features_compat(spark, sf):
    return _features(spark, sf, "compat")


def q_training_export(spark, sf):
    return features.training_export(_registry(spark, sf), PROFIT_THRESHOLD)


def q_training_from_csv(spark, sf):
    """List 2 written as CSV with unreadable cells for missing figures, read with schema inference, checked, featurised."""
    path = _scratch(spark, "csv")
    rows = fixtures.source2(spark, sf)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c in ("revenue", "profit")})
    rows.write.option("header", True).csv(path)
    raw = companies.read_csv_inferred(spark, path)
    return features.training_from_source(raw, PROFIT_THRESHOLD, min_rows=1, name_column="corporate_name_s2")


def q_hash_split(spark, sf):
    return features.hash_split(_features(spark, sf)).select("corporate_id", "label", "split")


def q_stratified_split(spark, sf):
    return features.stratified_split(_features(spark, sf)).select("corporate_id", "label", "split")


def q_train_test_counts(spark, sf):
    return features.split_counts(features.hash_split(_features(spark, sf)))


def q_rank_auc(spark, sf):
    """Exact AUC of revenue as a score for the profit label."""
    return evaluation.rank_auc(_features(spark, sf), score="revenue", label="label")


def q_classification_report(spark, sf):
    rule = _features(spark, sf).withColumn(
        "prediction", (F.col("revenue") > F.lit(RULE_REVENUE_CUTOFF)).cast("int"))
    return evaluation.classification_report(rule, "label", "prediction")


# ---------------------------------------------------------------- models

def _train_test(spark, sf):
    split = store.stage(features.hash_split(_features(spark, sf)), "split")
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def _scored(spark, sf, pipeline):
    """Each test row with what must hold for any fitted model: a score from 0 to 1, and the prediction on its side of one half."""
    train, test = _train_test(spark, sf)
    scored = learning.score(learning.fit(pipeline, train), test)
    score = F.col("prediction_score")
    return scored.select("corporate_id", "label", score.between(0.0, 1.0).alias("score_in_range"),
                         ((F.abs(score - 0.5) < 1e-9) | ((score > 0.5).cast("int") == F.col("prediction"))).alias("prediction_agrees"))


def _fitted(spark, sf):
    """(the logistic model at its optimum, training rows, test rows)."""
    train, test = _train_test(spark, sf)
    return learning.fit(learning.logistic_pipeline(max_iter=FIT_ITERATIONS, tol=FIT_TOLERANCE), train), train, test


def q_logistic_scores(spark, sf):
    """Each test row with the fitted model's prediction and score."""
    model, _, test = _fitted(spark, sf)
    return learning.score(model, test).select("corporate_id", "label", "prediction", F.round("prediction_score", 3).alias("prediction_score"))


def q_logistic_optimality(spark, sf):
    """The first-order condition of the fit, for the intercept and each feature."""
    model, train, _ = _fitted(spark, sf)
    return learning.optimality(learning.score(model, train)).select("coefficient", F.round("weight", 2).alias("weight"), F.round("residual", 5).alias("residual"))


def q_model_metrics(spark, sf):
    """A fitted model's run: its AUC, prediction rate and counts over the test rows, recorded and read back, and the drift of its predictions."""
    model, train, test = _fitted(spark, sf)
    scored = store.stage(learning.score(model, test), "scored")
    drift = reporting.drift_band(reporting.prediction_rate(scored), "prediction_rate", 0.5, 0.15).select(
        F.col("current_value").alias("prediction_rate"), F.col("is_anomaly").cast("double").alias("drifted"))
    both = reporting.combine_single_rows(evaluation.rank_auc(scored, "prediction_score", "label"), drift, train.agg(F.count("*").alias("train_count")),
                                         test.agg(F.count("*").alias("test_count")))
    value = lambda c: F.round(c, 3) if c == "auc" else F.col(c).cast("double")
    named = [F.struct(F.lit(c).alias("name"), value(c).alias("value"), F.lit(None).cast("string").alias("text")) for c in ("auc", "prediction_rate", "drifted", "train_count", "test_count")]
    named.append(F.struct(F.lit("features").alias("name"), F.lit(None).cast("double").alias("value"), F.lit(",".join(learning.LOGISTIC_FEATURES)).alias("text")))
    metrics = both.select(F.lit("fitted").alias("run_id"), F.lit("batch_001").alias("batch_id"), F.lit("model").alias("kind"),
                          F.explode(F.array(*named)).alias("m")).select("run_id", "batch_id", "kind", "m.*", F.current_timestamp().alias("recorded_at"))
    root = _scratch(spark, "metrics")
    store.append_metrics(spark, root, metrics)
    return store.read_metrics(spark, root).drop("recorded_at")


def q_forest_scores(spark, sf):
    return _scored(spark, sf, learning.forest_pipeline())


def _rule_predictions(spark, sf):
    """Batch predictions of a rule with a fixed cutoff, written and read back."""
    rule = _features(spark, sf).withColumn("prediction", (F.col("revenue") > F.lit(RULE_REVENUE_CUTOFF)).cast("int"))
    return store.stage(rule, "predictions")


def q_prediction_drift(spark, sf):
    return reporting.drift_band(reporting.prediction_rate(_rule_predictions(spark, sf)), "prediction_rate", 0.5, 0.15)


def q_run_metrics(spark, sf):
    """Numbers and parameters of a run, appended to the metrics table and read from it."""
    rows = _rule_predictions(spark, sf)
    both = reporting.combine_single_rows(evaluation.rank_auc(rows, "revenue", "label"), features.split_counts(features.hash_split(rows)))
    named = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"), F.lit(None).cast("string").alias("text")) for c in ("auc", "train_count", "test_count")]
    named.append(F.struct(F.lit("revenue_cutoff").alias("name"), F.lit(None).cast("double").alias("value"), F.lit("1000000").alias("text")))
    metrics = both.select(F.lit("registered").alias("run_id"), F.lit("batch_001").alias("batch_id"), F.lit("model").alias("kind"),
                          F.explode(F.array(*named)).alias("m")).select("run_id", "batch_id", "kind", "m.*", F.current_timestamp().alias("recorded_at"))
    root = _scratch(spark, "metrics")
    store.append_metrics(spark, root, metrics)
    return store.read_metrics(spark, root).drop("recorded_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
