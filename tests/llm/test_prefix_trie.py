import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import prefix_trie as op
from ledgerlink.llm.prefix_trie_query import SQL, op13_prefix_trie, rebuilt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The trie by dictionaries, from (conv_id, turn, role, text)."""
    content = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, content(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    members, children = defaultdict(list), defaultdict(set)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path)))
            if d:
                children[path[:d - 1]].add(path[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        saved[node] = (len(members[node]) - 1) * len(node[-1][1] if node else "") + sum(saved[x] for x in children[node])
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c, n in sorted(m) if n == len(node))
        out.append((min(m)[0], len(node), min(members[node[:-1]])[0] if node else None, len(m), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(r):
    return (r[1], r[0], r[7])


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit("x")).withColumn("DEPTH", F.lit(1)).withColumn("k", F.lit(None).cast("string"))
    out = op.prefix_trie(*rebuilt(df.repartition(3)), **options)
    return sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=key)


EDGES = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "hi"), (0, 2, "user", "more"), (0, 3, "assistant", "x"),
    *[(c, t, "user" if t % 2 == 0 else "assistant", f"{c % 3} {t}") for c in range(1, 40) for t in range(c % 7)],
    (41, None, None, None), (41, 1, "user", None), (41, 1, "user", ""), (41, 1, None, "user"), (41, 2, "us", "er"), (41, 2, "user", ""),  # ties, nulls
    (42, 0, "user", "a"), (42, 0, "user", "a"),                                              # a repeated row
    (None, 0, "user", "lost"), (105, 0, "user", "no base"), (106, 0, "user", "no base"),     # turnless when its head is cut off
    (200, 0, "user", "é漢😀 " * 4000), (201, 0, "user", "é漢😀 " * 4000), (202, 3, "system", ""),  # very long
]


def test_edges_against_plain(spark):
    assert run(spark, EDGES) == sorted(plain(EDGES), key=key)


def test_crowded_sketches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 8)
    monkeypatch.setattr(op, "MIN_WIDTH", 8)
    assert run(spark, EDGES, max_width=8) == sorted(plain(EDGES), key=key)


def test_a_hot_conversation_and_hot_beginnings(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 16)  # many blocks of turns
    monkeypatch.setattr(op, "SPAN_BITS", 2)  # member lists in many pieces
    rows = [(c, t, "user", f"same {t}") for c in (300, 301, 302) for t in range(120)] + [(c, t, "u", f"again {t}") for c in range(400, 460) for t in range(3)]
    rows += [(303, t, "user", f"same {t}" if t < 70 else f"other {t}") for t in range(130)]
    assert run(spark, rows) == sorted(plain(rows), key=key)


def test_empty_table_and_one_row(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, 0, "user", "x")]) == sorted(plain([(0, 0, "user", "x")]), key=key)


def test_sketch_never_underestimates(spark):
    digests = spark.range(3000).select(F.xxhash64(F.col("id") % 2000).alias("hi"), F.xxhash64(F.lit(5), F.col("id") % 2000).alias("lo")).repartition(5)
    width = 1 << 13
    table = op.sketch(digests, width)
    hi, lo = (np.array(x) for x in zip(*digests.select("hi", "lo").distinct().collect(), strict=True))
    twice = {tuple(r) for r in digests.groupBy("hi", "lo").count().filter("count > 1").select("hi", "lo").collect()}
    estimate = np.minimum(*[table[r, s] for r, s in enumerate(op._slots(hi, lo, width))])
    assert all(e == 2 for h, x, e in zip(hi.tolist(), lo.tolist(), estimate.tolist(), strict=True) if (h, x) in twice) and (estimate >= 1).all()
    assert (estimate == 1).sum() > 800  # most single digests are proven so


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/{sf}/conversations.parquet')")
    out = op13_prefix_trie(spark, f"/root/testdata/{sf}")
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(con.execute(SQL).fetchall(), key=key)
