"""The bucketed registry: merges against the plain merge, no exchange of the target, runs that end midway."""

import re
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators.upsert import DuplicateKeyError, merge_upsert
from ledgerlink.schemas import REGISTRY_SCHEMA
from ledgerlink.sources import bucketed


def rows(spark, keys, batch):
    data = [(f"{k:032x}", f"n{k}", "", "", "", "", float(k), 0.0, 100.0, True, False, datetime(2024, 1, 1), batch, "exact_name") for k in keys]
    return spark.createDataFrame(data, REGISTRY_SCHEMA)


@pytest.fixture()
def registry():
    return f"reg_{uuid.uuid4().hex[:8]}"


def content(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("buckets", [4, 8, 32])
def test_merge_moves_the_batch_only(spark, registry, scratch, buckets):
    first, second, third = rows(spark, range(500), "b1"), rows(spark, range(400, 900), "b2"), rows(spark, [3, 4000], "b3")
    bucketed.upsert_bucketed(spark, registry, first, folder=scratch, buckets=buckets)
    assert content(bucketed.read_bucketed(spark, registry)) == content(first)
    table = bucketed.upsert_bucketed(spark, registry, second, folder=scratch)
    want = merge_upsert(first, second)
    assert content(bucketed.read_bucketed(spark, registry)) == content(want)
    files = {m[1] for f in spark.table(table).inputFiles() if (m := re.search(r"_(\d{5})\.c\d+", f))}
    assert bucketed.buckets_of(spark, table) == buckets and len(spark.table(table).inputFiles()) == len(files) <= buckets  # one file a bucket
    merged = bucketed.merged_with(spark, registry, third)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's
    scan = next(line for line in plan.splitlines() if "FileScan" in line and registry in line)
    assert "Bucketed: true" in scan
    bucketed.upsert_bucketed(spark, registry, third, folder=scratch)
    assert content(bucketed.read_bucketed(spark, registry)) == content(merge_upsert(want, third))
    assert len(bucketed._versions(spark, registry)) == 2  # the current one and the one before


def test_a_run_that_ends_midway_changes_nothing(spark, registry, scratch, monkeypatch):
    first, second = rows(spark, range(50), "b1"), rows(spark, range(40, 90), "b2")
    bucketed.upsert_bucketed(spark, registry, first, folder=scratch, buckets=4)
    switch = bucketed._switch

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(bucketed, "_switch", lost)
    with pytest.raises(RuntimeError):
        bucketed.upsert_bucketed(spark, registry, second, folder=scratch)
    assert content(bucketed.read_bucketed(spark, registry)) == content(first)
    monkeypatch.setattr(bucketed, "_switch", switch)
    bucketed.upsert_bucketed(spark, registry, second, folder=scratch)
    assert content(bucketed.read_bucketed(spark, registry)) == content(merge_upsert(first, second))
    assert len(bucketed._versions(spark, registry)) == 2


def test_repeated_keys_and_empty_batches(spark, registry, scratch):
    first = rows(spark, range(20), "b1")
    bucketed.upsert_bucketed(spark, registry, first, folder=scratch, buckets=4)
    with pytest.raises(DuplicateKeyError):
        bucketed.upsert_bucketed(spark, registry, first.unionByName(first.limit(1)), folder=scratch)
    bucketed.upsert_bucketed(spark, registry, first.limit(0), folder=scratch)
    assert content(bucketed.read_bucketed(spark, registry)) == content(first)
    older = first.withColumns({"last_updated_ts": F.lit(datetime(2020, 1, 1)), "batch_id": F.lit("late")})
    bucketed.upsert_bucketed(spark, registry, older, folder=scratch, newer_by="last_updated_ts")
    assert content(bucketed.read_bucketed(spark, registry)) == content(first)
