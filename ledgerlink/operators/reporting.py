"""Reconciliation counts, consolidation ratio and drift bands as one-row DataFrames.

Counts come from single aggregate passes (``count_if`` per match type) rather than one
job per filter.  One-row aggregates are combined without any join: they are unioned
(each frame brings its own columns) and folded by one ``max`` per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.schemas import MATCH_TYPES

def combine_single_rows(*frames: DataFrame) -> DataFrame:
    """Single-row frames with distinct columns -> one row with all their columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    columns = [c for f in frames for c in f.columns]
    return out.agg(*[F.max(c).alias(c) for c in columns])


def match_type_counts(registry: DataFrame) -> DataFrame:
    """One row: final_rows and the count of each match type, one scan."""
    # Reconciliation field names, as the reference reports them.
    return registry.agg(
        F.count(F.lit(1)).alias("final_rows"),
        *[F.count_if(F.col("match_type") == t).alias(n) for t, n in zip(
            MATCH_TYPES, ("exact_matches", "fuzzy_matches", "source1_only", "source2_only"))])


def match_type_table(registry: DataFrame) -> DataFrame:
    """Long form: (match_type, rows)."""
    return registry.groupBy("match_type").agg(F.count(F.lit(1)).alias("rows"))


def reconciliation_report(source1: DataFrame, source2: DataFrame, registry: DataFrame) -> DataFrame:
    """source rows, final rows, duplicates removed, per-type counts and the match rate (%)."""
    s1 = source1.agg(F.count(F.lit(1)).alias("source1_rows"))
    s2 = source2.agg(F.count(F.lit(1)).alias("source2_rows"))
    counts = combine_single_rows(s1, s2, match_type_counts(registry))
    return counts.select(
        "source1_rows", "source2_rows", "final_rows",
        (F.col("source1_rows") + F.col("source2_rows") - F.col("final_rows")).alias("duplicates_removed"),
        "exact_matches", "fuzzy_matches", "source1_only", "source2_only",
        match_rate_pct(F.col("exact_matches") + F.col("fuzzy_matches"), F.col("final_rows")).alias("match_rate_pct"),
    )


def match_rate_pct(matched: Column, final_rows: Column) -> Column:
    return F.round(matched.cast("double") / F.greatest(final_rows, F.lit(1)).cast("double") * F.lit(100.0), 2)


def consolidation_ratio(source1: DataFrame, source2: DataFrame, staged: DataFrame) -> DataFrame:
    """Staged rows over input rows, 4 decimals (the pipeline's drift signal)."""
    s1 = source1.agg(F.count(F.lit(1)).alias("source1_rows"))
    s2 = source2.agg(F.count(F.lit(1)).alias("source2_rows"))
    st = staged.agg(F.count(F.lit(1)).alias("staged_rows"))
    return combine_single_rows(s1, s2, st).select(
        F.round(F.col("staged_rows").cast("double")
                / F.greatest(F.col("source1_rows") + F.col("source2_rows"), F.lit(1)).cast("double"), 4)
        .alias("value"))


def drift_band(current: DataFrame, metric: str, historical_avg: float | Column, tolerance: float = 0.15,
               value_column: str = "value") -> DataFrame:
    """Anomaly iff value < avg - tol or value > avg + tol (the band edges are normal)."""
    avg = historical_avg if isinstance(historical_avg, Column) else F.lit(float(historical_avg))
    tol = F.lit(float(tolerance))
    v = F.col(value_column)
    return current.select(
        F.lit(metric).alias("metric"),
        v.cast("double").alias("current_value"),
        avg.cast("double").alias("historical_avg"),
        tol.alias("tolerance"),
        ((v < avg - tol) | (v > avg + tol)).alias("is_anomaly"))


def historical_average(metrics: DataFrame, name: str) -> DataFrame:
    """Average of a recorded metric over past runs (one row, NULL when none)."""
    return metrics.filter(F.col("name") == name).agg(F.avg("value").alias("historical_avg"))


def drift_against_history(current: DataFrame, metrics: DataFrame, metric: str, tolerance: float = 0.15,
                          default_avg: float = 0.25) -> DataFrame:
    hist = historical_average(metrics, metric)
    both = combine_single_rows(current, hist)
    return drift_band(both, metric, F.coalesce(F.col("historical_avg"), F.lit(default_avg)), tolerance)


def prediction_rate(predictions: DataFrame, column: str = "prediction") -> DataFrame:
    """Mean prediction (share of positive predictions) as the drift signal."""
    return predictions.agg(F.avg(F.col(column).cast("double")).alias("value"))
