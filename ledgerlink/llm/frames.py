"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.session import checkpoint_root, delete_on_exit


#: Rows that go to a Python worker at once: whole texts may be long, and buffers of both sides hold a batch.
BATCH_ROWS = 1024


def modest_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS rows at most (a session that asks for fewer keeps its setting)."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared ``spark.checkpoint.dir`` and read it back.

    The plan above runs once, branches that follow read pruned columns, and a lost executor
    costs no recomputation of what lies above."""
    spark = df.sparkSession
    modest_batches(spark)
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not hold in either case (inputs may carry any extra columns)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: Column) -> Column:
    """With the id, what names a row: ids may be null or repeat.  Null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
