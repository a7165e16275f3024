from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators.upsert import (
    DuplicateKeyError, assert_unique_keys, keep_one_per_key, merge_upsert, merge_upsert_legacy, upsert_actions,
)
from ledgerlink.schemas import REGISTRY_SCHEMA
from ledgerlink.sources import store

TS = datetime(2024, 1, 1)


def reg(spark, rows):
    full = [(k, name, "", "", "", "", 1.0, 1.0, 100.0, True, True, TS, batch, mt) for k, name, batch, mt in rows]
    return spark.createDataFrame(full, REGISTRY_SCHEMA)


def as_dict(df):
    return {r["corporate_id"]: (r["canonical_name"], r["batch_id"], r["match_type"]) for r in df.collect()}


def test_merge_updates_inserts_and_keeps(spark):
    t = reg(spark, [("k1", "a", "b1", "exact_name"), ("k2", "b", "b1", "source1_only")])
    s = reg(spark, [("k2", "B", "b2", "fuzzy_name"), ("k3", "C", "b2", "source2_only")])
    got = as_dict(merge_upsert(t, s))
    assert got == {"k1": ("a", "b1", "exact_name"), "k2": ("B", "b2", "fuzzy_name"), "k3": ("C", "b2", "source2_only")}
    legacy = as_dict(merge_upsert_legacy(t, s))
    assert legacy["k2"] == ("B", "b2", "source1_only")     # match type left stale on update
    acts = {r["corporate_id"]: r["action"] for r in upsert_actions(t, s).collect()}
    assert acts == {"k2": "update", "k3": "insert"}


def test_merge_is_idempotent(spark):
    t = reg(spark, [("k1", "a", "b1", "exact_name")])
    s = reg(spark, [("k1", "A", "b2", "exact_name"), ("k9", "Z", "b2", "exact_name")])
    once = merge_upsert(t, s)
    assert as_dict(merge_upsert(once, s)) == as_dict(once)


def test_duplicate_staged_keys(spark):
    s = reg(spark, [("k1", "a", "b1", "exact_name"), ("k1", "b", "b1", "fuzzy_name")])
    with pytest.raises(DuplicateKeyError):
        assert_unique_keys(s)
    one = keep_one_per_key(s, ["canonical_name"])
    assert as_dict(one) == {"k1": ("a", "b1", "exact_name")}


def files_of(spark, root):
    return {f.split("/key_prefix=")[1] for f in spark.read.parquet(root).inputFiles()}


def test_only_touched_partitions_are_rewritten(spark, scratch):
    root = f"{scratch}/registry"
    store.create_registry(spark, root)
    assert store.read_registry(spark, root).count() == 0
    assert store.upsert_registry(spark, root, reg(spark, [("aa1", "a", "b1", "exact_name"), ("bb1", "b", "b1", "exact_name"), ("bb2", "c", "b1", "exact_name")])) == 2
    before = files_of(spark, root)
    assert store.upsert_registry(spark, root, reg(spark, [("bb1", "B", "b2", "fuzzy_name"), ("cc1", "d", "b2", "source2_only")])) == 2
    assert as_dict(store.read_registry(spark, root)) == {"aa1": ("a", "b1", "exact_name"), "bb1": ("B", "b2", "fuzzy_name"),
                                                         "bb2": ("c", "b1", "exact_name"), "cc1": ("d", "b2", "source2_only")}
    after = files_of(spark, root)
    assert {f for f in before if f.startswith("aa/")} == {f for f in after if f.startswith("aa/")}
    assert not {f for f in before if f.startswith("bb/")} & after
    assert store.upsert_registry(spark, root, reg(spark, [])) == 0
    with pytest.raises(DuplicateKeyError):
        store.upsert_registry(spark, root, reg(spark, [("k5", "x", "b3", "exact_name"), ("k5", "y", "b3", "exact_name")]))
    assert files_of(spark, root) == after
    with pytest.raises(FileNotFoundError):
        store.read_registry(spark, f"{scratch}/none")


def test_registry_by_table_name(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reg_db LOCATION '{scratch}/db'")
    store.upsert_registry(spark, "reg_db.companies", reg(spark, [("aa1", "a", "b1", "exact_name"), ("bb1", "b", "b1", "exact_name")]))
    store.upsert_registry(spark, "reg_db.companies", reg(spark, [("bb1", "B", "b2", "exact_name")]))
    assert as_dict(store.read_registry(spark, "reg_db.companies")) == {"aa1": ("a", "b1", "exact_name"), "bb1": ("B", "b2", "exact_name")}
    spark.sql("DROP DATABASE reg_db CASCADE")


def test_older_rows_dont_replace_newer_ones(spark):
    def dated(day, name):
        return reg(spark, [("k1", name, "b", "exact_name")]).withColumn("last_updated_ts", F.lit(day).cast("timestamp"))
    for day, want in (("2023-12-31", "old"), ("2024-01-02", "new"), ("2024-01-01", "new"), (None, "old")):
        got = merge_upsert(dated("2024-01-01", "old"), dated(day, "new"), newer_by="last_updated_ts")
        assert as_dict(got)["k1"][0] == want
    assert as_dict(merge_upsert(dated(None, "old"), dated(None, "new"), newer_by="last_updated_ts"))["k1"][0] == "new"


def test_metrics_table(spark, scratch):
    root = f"{scratch}/m"
    m = spark.createDataFrame([("r1", "b1", "drift", "consolidation_ratio", 0.6)],
                              "run_id string, batch_id string, kind string, name string, value double") \
        .withColumn("recorded_at", F.current_timestamp())
    store.append_metrics(spark, root, m)
    store.append_metrics(spark, root, m)
    assert store.read_metrics(spark, root).count() == 2
