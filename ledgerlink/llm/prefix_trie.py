"""The trie of conversations' shared beginnings, with count-min screening of prefix digests.

1. *Places.*  Turns are dealt by ranges of (conversation, turn), so a conversation of any length lies in as many partitions as it needs;
   a turn's place is its number inside its partition plus the counts of the partitions before.
2. *Digests.*  A turn's digest mixes its place with the SHA-256 of role and text; a prefix's digest is the sum of its turns' digests
   (128 bits in four lanes), taken as prefix sums by blocks of turns.
3. *Screening.*  Each task counts the digests it sees in a count-min sketch (saturating at two); sketches merge by slot.  An estimate of
   one proves that a prefix has a single member.  Such nodes are emitted from their own row, without a shuffle.
4. *Exact grouping* of the other prefixes.  A conversation is the smallest member of a stretch of its own path that reaches to
   its end, so the nodes fall into one chain for each conversation.  What a chain holds (leaves, savings) is summed over the members of
   each node: totals of whole subtrees from two aggregates, without going down level by level.

A sketch has ROWS rows of at most MAX_WIDTH slots of one byte, whatever the input: that bounds what tasks hold and what is
broadcast.  Beyond that size estimates rise and more prefixes go to the exact grouping; results don't change.

Defined results.  Null role or text counts as empty; rows without an id belong to no conversation.  Turns are ordered by number (null
first), ties by the SHA-256 of their role and text, so repeated rows are turns of their own.  Conversations without turns are
members of the root.  An empty table has no nodes.  Extra columns are passed over.  Very long texts are met by their digest only.  The list
of the members that end at a node is digested in order, piece by piece; no task holds it whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlink.llm.frames import modest_batches, stage

ROWS, MIN_WIDTH, MAX_WIDTH = 2, 1 << 12, 1 << 26
#: Bytes of a sketch that merge together.
PIECE = 4096
#: Turns (or nodes of a chain) whose prefix sum is taken in one group.
BLOCK = 1024
#: A piece of a node's member list spans this many ids (a power of two).
SPAN_BITS = 10
_LOW = (1 << 32) - 1
NODE = ["depth", "hi", "lo"]


def _running(df: DataFrame, key: str, place: str, sums: dict[str, str]) -> DataFrame:
    """``df`` with the sum of each column up to its row (column -> name of its sum), by dense places within a key.

    Sums are taken inside blocks of places and over the blocks before; a block holds BLOCK rows at most."""
    block = F.floor(F.col(place) / BLOCK).alias("_block")
    df = df.withColumn("_block", block)
    inside = W.partitionBy(key, "_block").orderBy(place).rowsBetween(W.unboundedPreceding, 0)
    out = df.withColumns({name: F.sum(c).over(inside) for c, name in sums.items()})
    totals = df.groupBy(key, "_block").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(key, "_block", *[F.sum(f"_t_{c}").over(before).alias(f"_t_{c}") for c in sums]).filter("_block > 0")
    return out.join(totals, [key, "_block"], "left").withColumns(
        {name: F.col(name) + F.coalesce(f"_t_{c}", F.lit(0)) for c, name in sums.items()}).drop("_block", *[f"_t_{c}" for c in sums])


def numbered(rows: DataFrame, key: str, order: list[str | Column], place: str) -> DataFrame:
    """``rows`` with their place (from 1) within their key; a key's rows may fill any number of tasks."""
    dealt = stage(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.sum("_n").over(before)).filter("_before > 0").drop("_n")
    own = F.row_number().over(W.partitionBy(key, "_part").orderBy(*order)).cast("long")
    return dealt.withColumn(place, own).join(offsets, [key, "_part"], "left").withColumn(
        place, F.col(place) + F.coalesce("_before", F.lit(0))).drop("_part", "_before")


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, k, content, chars): the turns by conversation and place, with the SHA-256 of role and text and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("content"), F.char_length(text).cast("long").alias("chars"))
    return numbered(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("content")], "k").drop("turn")


def _join_lanes(a: Column, b: Column) -> Column:
    return F.shiftleft(a.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(b.bitwiseAND(F.lit(_LOW)))


def prefixes(members: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each beginning of each conversation, the empty one included: (conv, depth, n, hi, lo, parent_hi, parent_lo, chars).

    ``members``: conv and n, its number of turns.  ``rows``: conv, n, d (its place from 1), content, chars."""
    first, second = F.xxhash64(F.lit(1), F.col("d"), F.col("content")), F.xxhash64(F.lit(2), F.col("content"), F.col("d"))
    low = lambda x: x.bitwiseAND(F.lit(_LOW))
    lanes = {"a": F.shiftrightunsigned(first, 32), "b": low(first), "c": F.shiftrightunsigned(second, 32), "e": low(second)}
    rows = rows.select("conv", "n", "d", "chars", *[v.alias(k) for k, v in lanes.items()])
    sums = _running(rows, "conv", "d", {k: f"s{k}" for k in lanes})
    up = lambda k: F.col(f"s{k}") - F.col(k)
    rows = sums.select("conv", F.col("d").alias("depth"), "n", _join_lanes(F.col("sa"), F.col("sb")).alias("hi"), _join_lanes(F.col("sc"), F.col("se")).alias("lo"),
                       _join_lanes(up("a"), up("b")).alias("parent_hi"), _join_lanes(up("c"), up("e")).alias("parent_lo"), "chars")
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    return rows.unionByName(members.select("conv", zero.alias("depth"), "n", zero.alias("hi"), zero.alias("lo"), none.alias("parent_hi"), none.alias("parent_lo"), zero.alias("chars")))


def _slots(hi: np.ndarray, lo: np.ndarray, width: int) -> list[np.ndarray]:
    return [x & np.int64(width - 1) for x in (lo, hi)]


def sketch(digests: DataFrame, width: int) -> np.ndarray:
    """The count-min sketch (ROWS x width, counts up to 2) of the digests (hi, lo): per task, then merged by pieces."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS, width), np.uint8)
        for b in batches:
            for r, slots in enumerate(_slots(*[b.column(c).to_numpy(zero_copy_only=False) for c in ("hi", "lo")], width)):
                at, n = np.unique(slots, return_counts=True)
                table[r, at] = np.minimum(table[r, at] + np.minimum(n, 2), 2)
        pieces = table.reshape(-1, PIECE)
        for at in np.array_split(used := np.flatnonzero(pieces.any(axis=1)), max(1, -(-len(used) // 256))):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([pieces[i].tobytes() for i in at], pa.binary())], names=["piece", "counts"])

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        total = np.zeros(PIECE, np.uint8)
        for x in group.column("counts"):
            total = np.minimum(total + np.frombuffer(x.as_buffer(), np.uint8), 2)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((ROWS * width // PIECE, PIECE), np.uint8)
    kind = "piece bigint, counts binary"
    for row in digests.select("hi", "lo").mapInArrow(count, kind).groupBy("piece").applyInArrow(merge, kind).collect():  # at most ROWS x width bytes
        out[row["piece"]] = np.frombuffer(bytes(row["counts"]), np.uint8)
    return out.reshape(ROWS, width)


def screened(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """``rows`` with alone and parent_alone: the estimate proves that the prefix (its parent) has one member."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = rows.columns

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        width = counts.shape[1]
        for b in batches:
            depth = b.column("depth").to_numpy(zero_copy_only=False)

            def one(hi: str, lo: str, least: int, b=b, depth=depth) -> pa.Array:
                parts = [b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in (hi, lo)]
                estimate = np.minimum(*[counts[r, at] for r, at in enumerate(_slots(*parts, width))])
                return pa.array((estimate == 1) & (depth >= least))

            yield pa.RecordBatch.from_arrays([*b.columns, one("hi", "lo", 1), one("parent_hi", "parent_lo", 2)], names=[*names, "alone", "parent_alone"])

    return rows.mapInArrow(look, f"{', '.join(f'{c} bigint' for c in names)}, alone boolean, parent_alone boolean")


def _ends(rows: DataFrame) -> DataFrame:
    """The SHA-256 of the comma-joined ids that end at each node, read in order piece by piece."""
    pieces = rows.groupBy(*NODE, F.shiftright("conv", SPAN_BITS).alias("span")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done = []
            for d, hi, lo, ids in zip(*[b.column(c).to_pylist() for c in [*NODE, "ids"]], strict=True):
                if (d, hi, lo) == node:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (d, hi, lo), hashlib.sha256()
                state.update(ids.encode())
            yield as_batch(done)
        if state is not None:
            yield as_batch([(*node, state.hexdigest())])

    def as_batch(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "span").mapInArrow(digest, "depth bigint, hi bigint, lo bigint, ends_sha256 string")


def prefix_trie(members: DataFrame, rows: DataFrame, max_width: int = MAX_WIDTH) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, screened.

    ``members`` and ``rows`` as for ``prefixes``; ``screened``: the sketch proved the node a singleton."""
    modest_batches(rows.sparkSession)
    every = stage(prefixes(members, rows), "prefixes")
    deeper = every.filter("depth > 0")
    width = min(max_width, max(MIN_WIDTH, 1 << (2 * deeper.count()).bit_length()))
    every = stage(screened(every, sketch(deeper, width)), "screened")
    tails, shared = every.filter("alone"), every.filter("not alone")

    nodes = stage(shared.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("rep"), F.max("chars").alias("chars"), F.max("parent_hi").alias("parent_hi"),
        F.max("parent_lo").alias("parent_lo"), F.max("parent_alone").alias("parent_alone")), "nodes")
    root = nodes.filter("depth = 0").select("rep").first()
    parent_of = [(F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")]
    children = (nodes.filter("depth > 0 and not parent_alone").select(*parent_of).unionAll(tails.filter("not parent_alone").select(*parent_of))
                .groupBy(*NODE).agg(F.count("*").alias("n_children")))
    nodes = nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")), "weight": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = stage(_running(nodes, "rep", "depth", {"weight": "upto"}), "counted")
    reps = nodes.select(F.col("rep").alias("parent_conv_id"), F.col("depth").alias("_d"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"))

    # chains: what each conversation's own nodes save, and whether its path ends in a childless node of its own
    chains = (nodes.select(F.col("rep").alias("conv"), "weight", (F.col("n_children") == 0).cast("long").alias("leaf"))
              .unionAll(tails.filter("depth = n").select("conv", F.lit(0).cast("long"), F.lit(1).cast("long")))
              .groupBy("conv").agg(F.sum("weight").alias("weight"), F.max("leaf").alias("leaf")).filter("weight > 0 or leaf > 0"))
    totals = (shared.select(*NODE, "conv").join(chains, "conv").groupBy(*NODE)
              .agg(F.sum("weight").alias("all_saved"), F.sum("leaf").alias("n_leaves")))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = (nodes.join(totals, NODE, "left").join(_ends(shared.filter("depth = n")), NODE, "left")
             .select(F.col("rep").alias("conv_id"), "depth", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
                     (F.coalesce("all_saved", F.lit(0).cast("long")) - (F.col("upto") - F.col("weight"))).alias("saved_tokens"),
                     F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "parent_hi", "parent_lo", "parent_alone", F.lit(False).alias("screened")))
    one = F.lit(1).cast("long")
    alone = tails.select(F.col("conv").alias("conv_id"), "depth", one.alias("n_convs"), (F.col("depth") < F.col("n")).cast("long").alias("n_children"),
                         one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                         F.when(F.col("depth") == F.col("n"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
                         "parent_hi", "parent_lo", "parent_alone", F.lit(True).alias("screened"))
    out = nodes.unionByName(alone)
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "screened"]
    # the parent's smallest member: the root's is one number, a proven singleton's is the node's own, the others' are looked up
    known = F.when(F.col("depth") == 1, F.lit(root["rep"] if root else None).cast("long")).when(F.col("parent_alone"), F.col("conv_id"))
    near = out.filter("depth <= 1 or parent_alone").withColumn("parent_conv_id", F.when(F.col("depth") > 0, known))
    far = out.filter("depth > 1 and not parent_alone").withColumn("_d", F.col("depth") - 1).join(reps, ["_d", "parent_hi", "parent_lo"])
    return near.select(*result).unionByName(far.select(*result))
