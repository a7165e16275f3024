"""Sharding by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size: it starts at one hash of its name and steps by
another.  Shards take turns; each claims its next preferred slot that is still free, until all slots are taken.  Shares differ
by one slot at most, and when a shard goes nearly all other slots keep their owner.  A row's slot is the hash of its key modulo
the table's size: placement is one lookup, whatever the number of shards.

The table has ``TABLE_SIZE`` rows, a parameter; it's broadcast, and doesn't grow with the input.  Rows aren't shuffled to be placed.

``write_shards`` writes one folder per shard.  A shard's rows are spread over tasks by a second hash of the whole row's key columns and
``salt_cols``, as many tasks as its rows need, so that a key that holds a third of all rows doesn't end in one task.

Defined results.  Null keys are a key of their own (all in one slot); empty texts and repeated rows are keys like any other; equal keys share a slot.  Empty
table: no rows.  One shard takes all slots.  No shards, repeated names, or more shards than slots are errors.  Very long texts are carried as they are (hashed whole where they
are keys); ties can't occur.  Extra columns are kept; where one is named like an output, the output's name gets ``_`` in front.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.frames import fresh

TABLE_SIZE = 65_537  # a prime


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The number of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, and there must be one at least")
    if not _is_prime(size) or len(shards) > size:
        raise ValueError("the table's size must be a prime, and no less than the number of shards")
    # by name, so that the table doesn't depend on the order in which shards are listed
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    start = [_hash(s, "start") % size for s in shards]
    step = [_hash(s, "step") % (size - 1) + 1 for s in shards]
    at = list(start)
    owner = np.full(size, -1, dtype=np.int64)
    free = size
    while free:
        for i in turns:
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) for every slot."""
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(owner.tolist())], "slot bigint, shard string")


def place(rows: DataFrame, key_cols: list[str], shards: list[str], size: int = TABLE_SIZE, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``rows`` plus their slot and shard, as the last two columns."""
    slot_col, shard_col = fresh(rows, slot_col), fresh(rows, shard_col)
    # the bytes of a key decide, not its type, and null differs from any text
    parts = [F.coalesce(F.concat(F.lit("+"), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in key_cols]
    slot = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("long")
    table = table_frame(rows.sparkSession, shards, size).withColumnsRenamed({"slot": slot_col, "shard": shard_col})
    return rows.withColumn(slot_col, slot).join(F.broadcast(table), slot_col, "left").select(*[F.col(f"`{c}`") for c in rows.columns], slot_col, shard_col)


def write_shards(rows: DataFrame, path: str, key_cols: list[str], shards: list[str], salt_cols: list[str], rows_per_file: int = 100_000, size: int = TABLE_SIZE,
                 slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """Write ``rows`` and their slots below ``path``, one folder per shard, in files of about ``rows_per_file``; the rows read back, columns as ``place`` gives them."""
    placed = place(rows, key_cols, shards, size, slot_col, shard_col)
    shard = placed.columns[-1]
    keys = [F.col(f"`{c}`") for c in dict.fromkeys(key_cols)]
    by_key = place(rows.select(*keys), key_cols, shards, size)
    counts = by_key.groupBy(F.col(f"`{by_key.columns[-1]}`").alias("of")).agg(F.count("*").alias("n")).collect()  # one row per shard
    files = {r["of"]: -(-r["n"] // rows_per_file) for r in counts}
    total = max(1, sum(files.values()))
    ways = F.coalesce(F.create_map(*[x for s, n in files.items() for x in (F.lit(s), F.lit(n))])[F.col(f"`{shard}`")], F.lit(1)) if files else F.lit(1)
    salt = fresh(placed, "_salt")
    salted = placed.withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_cols]), ways))
    salted.repartition(total, F.col(f"`{shard}`"), salt).drop(salt).write.partitionBy(shard).option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path).select(*[F.col(f"`{c}`") for c in placed.columns])
