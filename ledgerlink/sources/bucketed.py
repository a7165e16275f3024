"""The registry as a bucketed catalog table, merged without moving it.

Keys are hashes, so every batch of some thousand keys touches each part of a registry, however it is cut; what can be saved is the
shuffle.  The table is bucketed and sorted by the key.  The merge's full outer join reads it bucket by bucket where it lies, only the batch is
shuffled to the table's buckets, and each task writes the bucket that it read.

A registry is a catalog view over one version's table.  An upsert writes the next version and then replaces the view, so readers see a
version or the next one, and a driver that is lost on the way leaves the old version current; the next upsert removes what it left.  The version
before the current one stays, for queries that still read it.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlink.operators.harmonize import conform
from ledgerlink.operators.upsert import assert_unique_keys, merge_upsert
from ledgerlink.schemas import REGISTRY_COLUMNS, REGISTRY_KEY, REGISTRY_SCHEMA
from ledgerlink.sources.store import remove_folder, stage_at

VERSION = "__v"


def _versions(spark: SparkSession, registry: str) -> list[str]:
    """Tables of the registry's versions, oldest first (their numbers have a fixed width)."""
    database, _, name = registry.rpartition(".")
    tables = spark.catalog.listTables(database or None)
    return sorted((f"{database}." if database else "") + t.name for t in tables if t.name.startswith(f"{name}{VERSION}".lower()))


def _current(spark: SparkSession, registry: str) -> str | None:
    if not spark.catalog.tableExists(registry):
        return None
    return spark.sql(f"SHOW TBLPROPERTIES {registry} ('version')").first()["value"]


def _drop(spark: SparkSession, table: str) -> None:
    where = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")
    spark.sql(f"DROP TABLE {table}")
    remove_folder(spark, where)


def _write_version(spark: SparkSession, registry: str, rows: DataFrame, buckets: int, folder: str | None) -> str:
    done = _versions(spark, registry)
    number = int(done[-1].rpartition(VERSION)[2].partition("_")[0]) + 1 if done else 0
    table = f"{registry}{VERSION}{number:012d}_{uuid.uuid4().hex[:8]}".lower()
    writer = rows.select(*REGISTRY_COLUMNS).write.format("parquet").bucketBy(buckets, REGISTRY_KEY).sortBy(REGISTRY_KEY)
    if folder:
        writer = writer.option("path", f"{folder}/{table.rpartition('.')[2]}")
    writer.saveAsTable(table)
    return table


def _switch(spark: SparkSession, registry: str, table: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {registry} TBLPROPERTIES ('version' = '{table}') AS SELECT * FROM {table}")


def buckets_of(spark: SparkSession, table: str) -> int:
    return int(next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Num Buckets"))


def create_bucketed(spark: SparkSession, registry: str, buckets: int | None = None, folder: str | None = None) -> None:
    """An empty registry (nothing happens if there is one).  ``buckets``: the shuffle partitions of the session by default, so that the
    batch is shuffled to as many; ``folder``: where versions lie (default: the warehouse)."""
    if _current(spark, registry) is None:
        empty = spark.createDataFrame([], REGISTRY_SCHEMA)
        _switch(spark, registry, _write_version(spark, registry, empty, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), folder))


def merged_with(spark: SparkSession, registry: str, staged: DataFrame, update_columns=None, newer_by: str | None = None) -> DataFrame:
    """The registry after the merge, as a plan whose registry side has no exchange."""
    return merge_upsert(spark.table(_current(spark, registry)), staged, REGISTRY_KEY, update_columns, newer_by)


def upsert_bucketed(spark: SparkSession, registry: str, staged: DataFrame, update_columns=None, check_keys: bool = True,
                    newer_by: str | None = None, folder: str | None = None, buckets: int | None = None) -> str:
    """MERGE staged rows into the registry; the table of its new version."""
    create_bucketed(spark, registry, buckets, folder)
    before = _current(spark, registry)
    for table in _versions(spark, registry):
        if table > before:  # left by a run that didn't end
            _drop(spark, table)
    staged, copy = stage_at(conform(staged), "batch")
    if check_keys:
        assert_unique_keys(staged)
    merged = merged_with(spark, registry, staged, update_columns, newer_by)
    table = _write_version(spark, registry, merged, buckets_of(spark, before), folder)
    _switch(spark, registry, table)
    for old in _versions(spark, registry):
        if old < before:
            _drop(spark, old)
    remove_folder(spark, copy)
    return table


def read_bucketed(spark: SparkSession, registry: str) -> DataFrame:
    return spark.table(registry).select(*REGISTRY_COLUMNS)
