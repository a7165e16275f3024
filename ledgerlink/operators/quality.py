"""Data-quality rules as one aggregate pass per suite.

``*_report`` returns a tidy table ``(source, rule, column_name, observed, threshold, passed)``
computed by a single ``agg`` over the data (one scan, partial aggregation per task);
``enforce`` turns a failing report into ``DataQualityError`` (the circuit breaker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """Raised when a quality suite fails; the run stops before linking."""


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def _rule(source: str, rule: str, column: str | None, observed: Column, threshold: Column,
          passed: Column) -> Column:
    return F.struct(F.lit(source).alias("source"), F.lit(rule).alias("rule"),
                    F.lit(column).cast("string").alias("column_name"),
                    observed.cast("double").alias("observed"), threshold.cast("double").alias("threshold"),
                    passed.alias("passed"))


def quality_report(df: DataFrame, source: str, min_rows: int, name_column: str | None = None,
                   revenue_column: str | None = "revenue", spread_factor: float = 1000.0) -> DataFrame:
    """All rules of a suite in one pass.

    rules: row count >= min_rows; no null/blank name; no revenue < 0 (NULL and NaN pass);
    max revenue <= spread_factor * avg revenue (NULL stats pass).  Revenue rules are skipped
    when the column is absent, the name rule when no name column is given.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    if name_column:
        aggs.append(F.count_if(_blank(name_column)).alias("blank_names"))
    has_rev = revenue_column is not None and revenue_column in df.columns
    if has_rev:
        rev = F.expr(f"try_cast(`{revenue_column}` AS DOUBLE)")  # unparsable text counts as NULL
        aggs += [F.count_if(rev < 0).alias("negative_revenue"),
                 F.min(rev).alias("min_revenue"), F.max(rev).alias("max_revenue"), F.avg(rev).alias("avg_revenue")]
    stats = df.agg(*aggs)
    rules = [_rule(source, "min_row_count", None, F.col("rows"), F.lit(min_rows), F.col("rows") >= min_rows)]
    if name_column:
        rules.append(_rule(source, "non_blank", name_column, F.col("blank_names"), F.lit(0),
                           F.col("blank_names") == 0))
    if has_rev:
        rules.append(_rule(source, "non_negative", revenue_column, F.col("negative_revenue"), F.lit(0),
                           F.col("negative_revenue") == 0))
        spread_ok = (F.col("max_revenue").isNull() | F.col("avg_revenue").isNull()
                     | ~(F.col("max_revenue") > F.col("avg_revenue") * F.lit(spread_factor)))
        rules.append(_rule(source, "revenue_spread", revenue_column,
                           F.round(F.try_divide(F.col("max_revenue"), F.col("avg_revenue")), 6), F.lit(spread_factor), spread_ok))
    return stats.select(F.explode(F.array(*rules)).alias("r")).select("r.*")


def source1_report(df: DataFrame, min_rows: int, name_column: str = "corporate_name_s1") -> DataFrame:
    return quality_report(df, "source1", min_rows, name_column, revenue_column=None)


def source2_report(df: DataFrame, min_rows: int, name_column: str | None = "corporate_name_s2",
                   spread_factor: float = 1000.0) -> DataFrame:
    return quality_report(df, "source2", min_rows, name_column, "revenue", spread_factor)


def enforce(report: DataFrame) -> list:
    """The collected report (bounded: one row per rule); raises on any failed rule."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        detail = "; ".join(f"{r['source']}.{r['rule']}({r['column_name'] or '*'}): observed {r['observed']} "
                           f"vs {r['threshold']}" for r in failed)
        raise DataQualityError(detail)
    return rows


def run_source1_checks(df: DataFrame, min_rows: int) -> list:
    return enforce(source1_report(df, min_rows))


def run_source2_checks(df: DataFrame, min_rows: int, name_column: str | None = "corporate_name_s2") -> list:
    return enforce(source2_report(df, min_rows, name_column))
