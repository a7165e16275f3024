"""Resolution batch by batch against one run over all rows."""

import random

from pyspark.sql import functions as F

from ledgerlink.operators import linkage as L
from ledgerlink.plans import incremental

S1 = "corporate_name_s1 string, address string, activity_places string, top_suppliers string, batch_id string"
S2 = "corporate_name_s2 string, main_customers string, revenue double, profit double, batch_id string"


def batch(spark, rng, n, name):
    word = lambda: rng.choice(["Acme", "Globex", "Umbrella", "Initech", "Soylent"]) + " " + rng.choice(["North", "Northe", "South", "Sout", "Est"]) + str(rng.randrange(9))
    one = [(rng.choice([word(), word() + " Inc", "Inc", None]), "1 Road", f"p{rng.randrange(3)}|q", None, name) for _ in range(n)]
    two = [(rng.choice([word(), "Co. " + word(), "Ltd"]), f"c{rng.randrange(3)}", float(rng.randrange(9)), 1.0, name) for _ in range(n)]
    return spark.createDataFrame(one, S1), spark.createDataFrame(two, S2)


def content(df):
    return sorted((tuple(r) for r in df.select(*L.ENTITY_COLUMNS).collect()), key=repr)


def test_batches_add_up_to_one_run(spark, scratch):
    rng = random.Random(3)
    batches = {b: batch(spark, rng, n, b) for b, n in (("b1", 40), ("b2", 12), ("b3", 0), ("b4", 5))}
    for b, (s1, s2) in batches.items():
        incremental.resolve_batch(spark, scratch, s1, s2, b)
    s1, s2 = (batches["b1"][i].unionByName(batches["b2"][i]).unionByName(batches["b4"][i]) for i in (0, 1))
    want = content(L.resolve_entities(s1, s2))
    assert content(incremental.read_entities(spark, scratch)) == want
    incremental.resolve_batch(spark, scratch, *batches["b2"], "b2")  # a batch that runs again changes nothing
    assert content(incremental.read_entities(spark, scratch)) == want


def test_only_touched_partitions_are_read(spark, scratch):
    s1 = spark.createDataFrame([(f"{chr(97 + i % 26)}{chr(97 + i // 26)}company {i}", None, None, None, "b1") for i in range(300)], S1)
    s2 = spark.createDataFrame([], S2)
    incremental.resolve_batch(spark, scratch, s1, s2, "b1")
    rows = incremental._with_block(s1, "s1", 6)
    one = rows.limit(1).select(incremental.BLOCK, incremental.PART)
    part = one.first()[incremental.PART]
    read = incremental.touched_rows(spark, f"{scratch}/rows_s1", rows, one.select(incremental.BLOCK), [part], "b2")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"{incremental.PART}" in plan.split("PartitionFilters")[1].split("]")[0]
    files = {f.split(f"{incremental.PART}=")[1].split("/")[0] for f in read.inputFiles()}
    assert read.count() >= 1 and files >= {str(part)}
    metrics = read.select(F.count("*")).first()[0]
    assert metrics < 300
