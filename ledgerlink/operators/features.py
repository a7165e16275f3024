"""ML features, training-set builds and deterministic train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.functions.text import list_size
from ledgerlink.operators.harmonize import missing_with_defaults, null_normalized
from ledgerlink.operators.quality import enforce, source2_report
from ledgerlink.schemas import FEATURE_COUNT_COLUMNS, LIST_COLUMNS, REGISTRY_COLUMNS, REGISTRY_KEY, require_columns

TRAINING_COLUMNS = ["revenue", "profit", *FEATURE_COUNT_COLUMNS, "label"]
EXPORT_REQUIRED = [*LIST_COLUMNS, "revenue", "profit"]
# the registry's key, figures and lists, then what is derived from them; kept where present
EXPORT_COLUMNS = [REGISTRY_KEY, *[c for c in ("revenue", "profit", *LIST_COLUMNS) if c in REGISTRY_COLUMNS],
                  *FEATURE_COUNT_COLUMNS, "label"]


def list_count(c: str, mode: str = "parsed") -> Column:
    """Items in a pipe list.  parsed: blank items and null/'' count 0.
    compat: plain split size, so '' counts 1 and null counts -1."""
    if mode == "parsed":
        return list_size(c).cast("int")
    if mode == "compat":
        return F.coalesce(F.size(F.split(F.col(c), r"\|")), F.lit(-1)).cast("int")
    raise ValueError(f"unknown list mode {mode!r}")


def add_ml_features(df: DataFrame, profit_threshold: float, list_mode: str = "parsed") -> DataFrame:
    """revenue/profit NULL or NaN -> 0.0; three list counts; label = profit > threshold."""
    fill = {c: 0.0 for c in ("revenue", "profit") if c in df.columns}
    df = df.na.fill(fill) if fill else df
    counts = {n: list_count(c, list_mode) for c, n in zip(LIST_COLUMNS, FEATURE_COUNT_COLUMNS)}
    return df.withColumns(counts).withColumn(
        "label", F.when(F.col("profit") > F.lit(float(profit_threshold)), 1).otherwise(0).cast("int"))


def training_export(registry: DataFrame, profit_threshold: float = 1000000.0,
                    list_mode: str = "parsed") -> DataFrame:
    """Registry -> training rows: contract check, null normalisation, features, and the
    optional columns that exist (the key included)."""
    require_columns(registry, EXPORT_REQUIRED, "registry")
    featured = add_ml_features(null_normalized(registry), profit_threshold, list_mode)
    return featured.select(*[c for c in EXPORT_COLUMNS if c in featured.columns])


def training_from_source(df: DataFrame, profit_threshold: float = 1000.0, min_rows: int = 1,
                         name_column: str | None = None, list_mode: str = "parsed",
                         check: bool = True) -> DataFrame:
    """Finance-like rows -> the six training columns, after the source-2 quality suite."""
    if check:
        enforce(source2_report(df, min_rows, name_column))
    featured = add_ml_features(null_normalized(missing_with_defaults(df)), profit_threshold, list_mode)
    return featured.select(*TRAINING_COLUMNS)


def _hash_hex(key: str | Column) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.sha2(k.cast("string"), 256)


def hash_split(df: DataFrame, key: str = "corporate_id", train_fraction: float = 0.8) -> DataFrame:
    """split = 'train' | 'test' from a hash of the key: stable across runs, partitionings
    and engines (the first 24 bits of SHA-256 against fraction * 2^24)."""
    cutoff = format(int(round(train_fraction * 16 ** 6)), "06x")
    return df.withColumn("split", F.when(F.substring(_hash_hex(key), 1, 6) < F.lit(cutoff), "train")
                         .otherwise("test"))


def stratified_split(df: DataFrame, label: str = "label", key: str = "corporate_id",
                     test_fraction: float = 0.2) -> DataFrame:
    """Exactly ceil(test_fraction * n_label) rows of every label go to 'test'; order by a
    hash of the key.

    No window over a whole label: rows are bucketed by the first 16 hash bits; a per-label
    running count over the bucket table (at most labels x 65536 rows) tells each bucket
    how many test slots precede it, and only a rank inside each (label, bucket) is needed.
    """
    h = _hash_hex(key)
    rows = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 4))
    buckets = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy(label).orderBy("_b")
    buckets = buckets.select(
        label, "_b",
        F.coalesce(F.sum("_n").over(by_label.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.ceil(F.sum("_n").over(Window.partitionBy(label)) * F.lit(float(test_fraction))).alias("_k"))
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h", F.col(key).cast("string"))
    return (rows.join(buckets, [label, "_b"])
            .withColumn("split", F.when(F.col("_before") + F.row_number().over(in_bucket) <= F.col("_k"), "test")
                        .otherwise("train"))
            .drop("_h", "_b", "_before", "_k"))


def split_counts(split_df: DataFrame) -> DataFrame:
    """One row: train_count, test_count (one pass)."""
    return split_df.agg(F.count_if(F.col("split") == "train").alias("train_count"),
                        F.count_if(F.col("split") == "test").alias("test_count"))
