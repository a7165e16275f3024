"""The registry as a plain Spark table: parquet, partitioned by the first characters of the key.

A registry is named like a catalog table (``db.registry``) or, if the name has a slash in it, by a folder.
An upsert reads and rewrites only the partitions that its keys fall into (Spark's dynamic partition
overwrite); files of all others stay as they are.  The keys are hashes, so partitions are even.

One writer per registry at a time: parquet tables know no conflicts.  Where the catalog's tables support MERGE,
``DataFrame.mergeInto`` does the same with the same key and columns.

Staging copies and lineage cuts go under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.operators.harmonize import conform
from ledgerlink.operators.upsert import assert_unique_keys, merge_upsert
from ledgerlink.schemas import REGISTRY_COLUMNS, REGISTRY_KEY, REGISTRY_SCHEMA
from ledgerlink.session import checkpoint_root, delete_on_exit

PREFIX = "key_prefix"
PREFIX_CHARS = 2  # hexadecimal keys: 256 partitions
TABLE_SCHEMA = T.StructType([*REGISTRY_SCHEMA.fields, T.StructField(PREFIX, T.StringType())])

# value holds numbers, text what isn't one (parameters, lists, reports)
METRIC_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
])


def _is_folder(registry: str) -> bool:
    return "/" in registry


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _folder_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)


# ---------------------------------------------------------------- staging

def stage_at(df: DataFrame, name: str = "staging") -> tuple[DataFrame, str]:
    """(the rows written once in the shared checkpoint folder and read back, that folder)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/ledgerlink-{name}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str = "staging") -> DataFrame:
    """As ``stage_at`` for rows that are read until the application ends."""
    return stage_at(df, name)[0]


# ---------------------------------------------------------------- registry

def registry_exists(spark: SparkSession, registry: str) -> bool:
    return _folder_exists(spark, registry) if _is_folder(registry) else spark.catalog.tableExists(registry)


def create_registry(spark: SparkSession, registry: str) -> None:
    """Empty typed registry (nothing happens if there is one)."""
    if registry_exists(spark, registry):
        return
    writer = spark.createDataFrame([], TABLE_SCHEMA).write.partitionBy(PREFIX)
    if _is_folder(registry):
        writer.parquet(registry)
    else:
        writer.format("parquet").saveAsTable(registry)


def _table(spark: SparkSession, registry: str) -> DataFrame:
    if not registry_exists(spark, registry):
        raise FileNotFoundError(f"there is no registry {registry}")
    return spark.read.schema(TABLE_SCHEMA).parquet(registry) if _is_folder(registry) else spark.table(registry)


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    return _table(spark, registry).select(*REGISTRY_COLUMNS)


def _write_partitions(spark: SparkSession, registry: str, rows: DataFrame) -> None:
    """Replace the partitions that ``rows`` has; rows of a partition are spread by key range."""
    rows = rows.repartitionByRange(REGISTRY_KEY).select(*TABLE_SCHEMA.names)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        if _is_folder(registry):
            rows.write.mode("overwrite").partitionBy(PREFIX).parquet(registry)
        else:
            rows.write.mode("overwrite").insertInto(registry)
            spark.catalog.refreshTable(registry)
    finally:
        spark.conf.set(setting, before)


def upsert_registry(spark: SparkSession, registry: str, staged: DataFrame, update_columns=None,
                    check_keys: bool = True, newer_by: str | None = None) -> int:
    """MERGE staged rows into the registry; how many partitions were rewritten.

    ``check_keys`` fails on repeated staged keys first (one aggregate over the batch).  ``newer_by``: a
    matched row is only updated if the staged one isn't older by this column."""
    staged = conform(staged)
    if check_keys:
        assert_unique_keys(staged)
    create_registry(spark, registry)
    prefix = F.substring(REGISTRY_KEY, 1, PREFIX_CHARS)
    touched = [r[0] for r in staged.select(prefix.alias("p")).distinct().collect()]  # 16^PREFIX_CHARS at most
    if not touched:
        return 0
    target = _table(spark, registry).filter(F.col(PREFIX).isin(touched)).select(*REGISTRY_COLUMNS)
    merged = merge_upsert(target, staged, REGISTRY_KEY, update_columns, newer_by).withColumn(PREFIX, prefix)
    rows, folder = stage_at(merged, "merged")  # what is overwritten can't be read meanwhile
    _write_partitions(spark, registry, rows)
    remove_folder(spark, folder)
    return len(touched)


# ---------------------------------------------------------------- metrics

def append_metrics(spark: SparkSession, root: str, metrics: DataFrame) -> None:
    """Append run metrics (columns of METRIC_SCHEMA; absent ones NULL) to ``root/_metrics``."""
    have = [F.col(f.name) if f.name in metrics.columns else F.lit(None) for f in METRIC_SCHEMA.fields]
    metrics.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(have, METRIC_SCHEMA.fields)]) \
        .coalesce(1).write.mode("append").parquet(f"{root}/_metrics")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    if not _folder_exists(spark, f"{root}/_metrics"):
        return spark.createDataFrame([], METRIC_SCHEMA)
    return spark.read.schema(METRIC_SCHEMA).parquet(f"{root}/_metrics")
