"""Company-list scans (CSV with header) and lineage tagging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.schemas import SOURCE1_SCHEMA, SOURCE2_RAW_SCHEMA, require_columns

NUMERIC_SOURCE2_COLUMNS = ("revenue", "profit")


def tag_source(df: DataFrame, source_name: str, batch_id: str) -> DataFrame:
    """Lineage columns every ingested row carries."""
    return df.withColumns({
        "source_name": F.lit(source_name),
        "batch_id": F.lit(batch_id),
        "ingestion_ts": F.current_timestamp(),
    })


def to_double(c: str) -> F.Column:
    """Text or number -> double; unparsable text -> NULL (never an ANSI error)."""
    return F.expr(f"try_cast(`{c}` AS DOUBLE)")


def _read_by_header(spark: SparkSession, path: str, columns: list[str], what: str) -> DataFrame:
    """The named columns of a CSV with a header, as text, in whatever order they stand; other columns are left out."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    require_columns(df, columns, what)
    return df.select(*columns)


def read_source1(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """Supply-side list: all four columns text, bound by header name (no inference pass)."""
    return tag_source(_read_by_header(spark, path, SOURCE1_SCHEMA.names, "source 1"), "source1", batch_id)


def read_source2(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    """Finance-side list, bound by header name: revenue/profit converted with try_cast."""
    df = _read_by_header(spark, path, SOURCE2_RAW_SCHEMA.names, "source 2")
    df = df.withColumns({c: to_double(c) for c in NUMERIC_SOURCE2_COLUMNS})
    return tag_source(df, "source2", batch_id)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with schema inference (costs one extra pass; prefer an explicit schema)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
