"""Reproduces the LCS engine measurement quoted in the README.

Pairs: every list-1 name with every list-2 name sharing its first two sorted characters
(sf0.1: about 4.4M pairs).  Prints pairs/s/core for the arrow and jvm engines and checks
that both give the same total.
usage: python tools/measure_lcs.py [sf_dir] [cores]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlink.functions.similarity import lcs_length, lcs_length_arrow  # noqa: E402
from ledgerlink.functions.text import sort_tokens  # noqa: E402
from ledgerlink.operators import linkage as L  # noqa: E402
from ledgerlink.session import local_session  # noqa: E402
from ledgerlink.sources import fixtures  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    s1, s2 = fixtures.company_sources(spark, sf)
    g1 = L.cut_lineage(L.collapse_side(L.prepare_source1(s1), "s1"), "side1")
    g2 = L.cut_lineage(L.collapse_side(L.prepare_source2(s2), "s2"), "side2")
    a = L.named(g1, "s1").select(sort_tokens("clean_name_s1").alias("a")).withColumn("k", F.substring("a", 1, 2))
    b = L.named(g2, "s2").select(sort_tokens("clean_name_s2").alias("b")).withColumn("k", F.substring("b", 1, 2))
    pairs = L.cut_lineage(a.join(b, "k").repartition(cores), "pairs")
    n = pairs.count()
    totals = {}
    for name, col in (("arrow", lcs_length_arrow("a", "b")), ("jvm", lcs_length("a", "b"))):
        df = pairs.select(col.alias("l"))
        df.agg(F.sum("l")).collect()  # warm-up
        t0 = time.time()
        totals[name] = df.agg(F.sum("l")).collect()[0][0]
        dt = time.time() - t0
        print(f"{name}: {n} pairs in {dt:.2f}s = {n / dt / cores / 1e3:.0f}k pairs/s/core")
    print("identical totals:", totals["arrow"] == totals["jvm"])


if __name__ == "__main__":
    main()
