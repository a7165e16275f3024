from pyspark.sql import functions as F

from ledgerlink.operators.reporting import (
    consolidation_ratio, drift_against_history, drift_band, match_type_counts, reconciliation_report,
)


def test_reconciliation_counts_and_rate(spark):
    s1, s2 = spark.range(47), spark.range(31)
    kinds = ["exact_name"] * 11 + ["fuzzy_name"] * 2 + ["source1_only"] * 29 + ["source2_only"] * 17
    registry = spark.createDataFrame([(k,) for k in kinds], "match_type string")
    r = reconciliation_report(s1, s2, registry).first()
    assert (r["source1_rows"], r["source2_rows"], r["final_rows"], r["duplicates_removed"]) == (47, 31, 59, 19)
    assert (r["exact_matches"], r["fuzzy_matches"], r["source1_only"], r["source2_only"]) == (11, 2, 29, 17)
    assert r["match_rate_pct"] == 22.03
    assert match_type_counts(registry).first()["final_rows"] == 59


def band(spark, cur, avg, tol):
    return drift_band(spark.createDataFrame([(cur,)], "value double"), "m", avg, tol).first()["is_anomaly"]


def test_drift_band(spark):
    assert band(spark, 0.8125, 0.5, 0.25) is True
    assert band(spark, 0.625, 0.5, 0.25) is False
    assert band(spark, 0.1875, 0.5, 0.25) is True
    assert band(spark, 0.75, 0.5, 0.25) is False      # band edges are normal
    assert band(spark, 0.25, 0.5, 0.25) is False


def test_consolidation_ratio_and_history(spark):
    r = consolidation_ratio(spark.range(70), spark.range(50), spark.range(89)).first()["value"]
    assert r == 0.7417
    hist = spark.createDataFrame([("consolidation_ratio", 0.6), ("consolidation_ratio", 0.7), ("other", 9.0)],
                                 "name string, value double")
    d = drift_against_history(spark.createDataFrame([(0.66,)], "value double"), hist, "consolidation_ratio", 0.1).first()
    assert abs(d["historical_avg"] - 0.65) < 1e-12 and d["is_anomaly"] is False
    empty = hist.filter(F.lit(False))
    d = drift_against_history(spark.createDataFrame([(0.66,)], "value double"), empty, "consolidation_ratio", 0.15).first()
    assert d["historical_avg"] == 0.25 and d["is_anomaly"] is True


def test_scale_conf():
    from ledgerlink.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)          # 100 TiB on 1000 executors x 8 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"
