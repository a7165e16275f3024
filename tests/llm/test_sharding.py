import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import sharding as op
from ledgerlink.llm.sharding_query import SHARDS, op3_sharding

from .edge_cases import empty, frame, rows


def plain(shards, size):
    """Each shard's whole order of preference, then turns."""
    order = {s: [(op._hash(s, "start") + j * (op._hash(s, "step") % (size - 1) + 1)) % size for j in range(size)] for s in shards}
    owner = {}
    while len(owner) < size:
        for s in sorted(shards):
            free = next((x for x in order[s] if x not in owner), None)
            if free is not None:
                owner[free] = s
    return [owner[i] for i in range(size)]


@pytest.mark.parametrize("size", [2, 3, 101, 251])
def test_table_matches_a_plain_version(size):
    for n in (1, 2, 5, 50):
        if n <= size:
            shards = [f"s{i}" for i in range(n)]
            assert [shards[k] for k in op.lookup_table(shards, size)] == plain(shards, size)
            assert [shards[::-1][k] for k in op.lookup_table(shards[::-1], size)] == plain(shards, size)


def test_shares_are_even_and_few_slots_move():
    shards = [f"s{i}" for i in range(50)]
    table = op.lookup_table(shards, 10007)
    share = np.bincount(table)
    assert share.max() - share.min() <= 1
    fewer = op.lookup_table(shards[1:], 10007)
    stay = table != 0
    assert (np.array(shards)[table[stay]] == np.array(shards[1:])[fewer[stay]]).mean() > 0.9


def test_wrong_tables_are_refused():
    for shards, size in (([], 7), (["a", "a"], 7), (["a"], 8), ([str(i) for i in range(9)], 7)):
        with pytest.raises(ValueError):
            op.lookup_table(shards, size)


def test_edge_cases(spark, scratch):
    df, shards = frame(spark), ["x", "y", "z"]
    out = op.place(df, ["doc_id", "text"], shards, size=251)
    assert out.columns == [*df.columns, "slot", "shard"] and out.filter("shard is null").count() == 0 and out.count() == len(rows())
    by = {}
    for r in out.collect():
        assert by.setdefault((r["doc_id"], r["text"]), r["slot"]) == r["slot"]
    assert op.place(empty(spark), ["doc_id"], shards).count() == 0
    named = df.withColumn("Slot", F.lit("own")).withColumn("shard", F.lit(None).cast("int"))
    assert op.place(named, ["doc_id"], shards).columns == [*named.columns, "_slot", "_shard"]
    hot = named.withColumn("hot", F.lit("one key"))
    back = op.write_shards(hot, f"{scratch}/out", ["hot"], shards, ["doc_id", "text"], rows_per_file=4, size=251)
    assert back.columns == op.place(hot, ["hot"], shards, size=251).columns
    assert back.count() == len(rows()) and back.select("_shard").distinct().count() == 1 and len(back.inputFiles()) > 1
    assert sorted(map(str, back.drop("_slot", "_shard").collect())) == sorted(map(str, hot.collect()))
    assert op.write_shards(empty(spark), f"{scratch}/none", ["doc_id"], shards, ["doc_id"]).count() == 0


def order_of(shard):
    at, step = op._hash(shard, "start"), op._hash(shard, "step") % (op.TABLE_SIZE - 1) + 1
    for j in range(op.TABLE_SIZE):
        yield (at + j * step) % op.TABLE_SIZE


def test_query_places_every_document_by_a_plain_slot_and_the_whole_table(spark):
    given = "/root/testdata/sf0.001"
    out = op3_sharding(spark, given).collect()
    docs = spark.read.parquet(f"{given}/documents.parquet").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r["doc_id"] for r in docs)
    # turns with the whole table's size, each shard walking on from its own start
    for names, col in ((SHARDS, "shard"), (SHARDS[1:], "shard_without_first")):
        walk = {x: order_of(x) for x in names}
        owner = {}
        while len(owner) < op.TABLE_SIZE:
            for x in sorted(names):
                free = next((i for i in walk[x] if i not in owner), None)
                if free is not None:
                    owner[free] = x
        for r in out:
            slot = int(hashlib.md5(f"+{r['doc_id']}".encode()).hexdigest()[:15], 16) % op.TABLE_SIZE
            assert r["slot"] == slot and r[col] == owner[slot]
