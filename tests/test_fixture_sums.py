"""Revenue and profit of the derived list 2 against plain decimal sums."""

from decimal import Decimal
import os
import random

from pyspark.sql import functions as F

from ledgerlink.sources import fixtures

SF = "/root/testdata/sf0.001"

ODD = [0.0, -0.0, 0.005, 1.005, 2.675, 84197.045, 84197.04, -0.015, 123456789.01, 1e11 + 0.01, 9999999999999.99, 1e-9, None]


def test_hundredths_are_those_of_the_decimal(spark):
    rng = random.Random(5)
    rows = [(v,) for v in ODD + [round(rng.uniform(-1e5, 1e5), rng.choice([1, 2, 3, 6])) for _ in range(500)]]
    df = spark.createDataFrame(rows, "v double")
    for r in df.select("v", fixtures._hundredths("v", 15).alias("h"), F.col("v").cast("decimal(15,2)").alias("d")).collect():
        assert r["h"] == (None if r["d"] is None else int(r["d"] * 100)), r["v"]


def test_product_sums_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, p, rng.choice([0, 7, -3, 10099])) for k in range(4) for p in (10**15 - 1, 10**15 - 1, -999_999, 1, 8419704, None)] + [(9, None, 1)]
    got = {r["k"]: r["s"] for r in spark.createDataFrame(rows, "k int, p bigint, f bigint").groupBy("k").agg(
        fixtures._product_sum(F.col("p"), F.col("f")).alias("s")).collect()}
    for k in range(4):
        assert got[k] == Decimal(sum(p * f for kk, p, f in rows if kk == k and p is not None)) / 10000
    assert got[9] is None


def test_sums_take_longs_only(spark):
    """No decimal is built for a line item: the aggregate's buffers are longs."""
    df = spark.createDataFrame([(1, 5, 5)], "k int, p bigint, f bigint").groupBy("k").agg(fixtures._product_sum(F.col("p"), F.col("f")).alias("s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast" not in plan and "decimal" not in plan.split("sum(")[1].split(")")[0]


def test_line_items_are_not_dealt_by_customer(spark):
    """Customers meet the orders first: with a customer table too large to broadcast, line items pass no exchange for it."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixtures.source2(spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    dealt = [below for line, below in zip(plan, plan[1:]) if "hashpartitioning(o_custkey" in line]
    assert dealt and not any("l_partkey" in below for below in dealt)


def test_segments_of_odd_orders(spark, scratch):
    """Orders and customers whose keys repeat, are missing or are null."""
    import shutil
    for t in ("part", "supplier", "nation"):
        shutil.copy(f"{SF}/{t}.parquet", scratch) if not os.path.isdir(f"{SF}/{t}.parquet") else shutil.copytree(f"{SF}/{t}.parquet", f"{scratch}/{t}.parquet")
    like = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders", "customer")}
    blank = lambda t, **given: tuple(given.get(c) for c in like[t].columns)
    items = [(1, 4), (1, 5), (2, 5), (3, 6), (None, 7), (4, None), (5, 8)]
    orders = [(1, 10), (1, 11), (2, 12), (3, None), (None, 10), (4, 10), (5, 99)]
    customers = [(10, "B"), (10, "A"), (11, "B"), (12, None), (None, "Z")]
    given = {"lineitem": [blank("lineitem", l_orderkey=o, l_partkey=p) for o, p in items],
             "orders": [blank("orders", o_orderkey=o, o_custkey=c) for o, c in orders],
             "customer": [blank("customer", c_custkey=c, c_mktsegment=m) for c, m in customers]}
    for t, rows in given.items():
        spark.createDataFrame(rows, like[t].schema).coalesce(1).write.parquet(f"{scratch}/{t}.parquet")
    got = {r["corporate_name_s2"].lower().replace("(limited)", "").replace("co.", "").replace("/", "").split()[-1]: r["main_customers"]
           for r in fixtures.source2(spark, scratch).collect() if r["profit"] is None and r["main_customers"] != "WHOLESALE|BUILDING" and r["corporate_name_s2"] != "Limited"}
    assert got["4"] == "A|B" and got["5"] == "A|B"
    assert got["6"] is None and got["7"] is None and got["8"] is None
