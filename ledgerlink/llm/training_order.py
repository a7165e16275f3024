"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed stride.

1. *Sequences.*  Each text is encoded and followed by the end-of-text id; its tokens are cut into sequences of ``LENGTH``, the last one filled up with
   the fill id.  (Every sequence has the same number of bytes.)
2. *Numbers.*  A task counts its sequences as it encodes, and the encoded texts are written once with (task, count so far).  Sums of the tasks' totals (one row
   a task) give each sequence its number.  No tokens are shuffled for this; the written table fixes the numbers, whatever is lost or retried.
3. *Order.*  A keyed Feistel network permutes the numbers 0 .. 2^b - 1, the least such range that holds all sequences; a number that lands beyond
   the last slot is permuted again until it lands inside (cycle-walking).  So the slots are exactly 0 .. N - 1, each once, with no sort
   key to store, and any slot's sequence can be told from the key and N alone.
4. *Shards.*  Range partitions by slot write parquet files of rows (slot, tokens) in slot order; shard s holds the slots s * STRIDE to (s + 1) * STRIDE - 1.
   As slots are dense, a shard's number tells its task: ranges of consecutive shards, ``SHARDS_A_TASK`` at most, are dealt by arithmetic, without a sample or sort to find bounds.
   A reader resumes at any slot: slot // STRIDE names the folder, and min/max statistics find the row group.

Defined results.  Null or empty text: one sequence, the end-of-text id and fill.  Null ids are carried; repeated rows get sequences of their own.  Ties can't occur: a number is one sequence's.
Very long texts: encoded whole by one task, as many sequences as they need.  Empty table: no sequences, and no shard is written.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerlink.llm.byte_bpe import read_ranks
from ledgerlink.llm.frames import stage
from ledgerlink.llm.wordgrams import mix

LENGTH = 512
STRIDE = 16_384
#: A shard is 16 MB of ids; so many at most are written by one task.
SHARDS_A_TASK = 16
ROUNDS = 4
ROWS = 256


def id_type(n_tokens: int) -> np.dtype:
    """Two bytes a token where the ids, the end-of-text id and the fill id allow, else four; little-endian."""
    return np.dtype("<u2") if n_tokens + 2 <= 1 << 16 else np.dtype("<u4")


def encoded(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_tokens, n_sequences, task, before, tokens): tokens are the bytes of a text's sequences; before counts the task's sequences so far.

    To be written and read back before use.  The rank file is read by the driver and broadcast; a vocabulary is a fixed file of about a megabyte."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    tokens = read_ranks(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    kind, end, fill = id_type(len(tokens)), len(tokens), len(tokens) + 1
    schema = T.StructType([rows.schema["id"], *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_sequences", "task", "before")], T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(shared.value)}, special_tokens={})
        task, upto = TaskContext.get().partitionId(), 0
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                n_tokens, n_sequences, before, blobs = [], [], [], []
                for text in part.column("text").to_pylist():
                    ids = encoding.encode_ordinary(text or "")
                    n = len(ids) // length + 1
                    whole = np.full(n * length, fill, dtype=kind)
                    whole[:len(ids)] = ids
                    whole[len(ids)] = end
                    n_tokens.append(len(ids) + 1)
                    n_sequences.append(n)
                    before.append(upto)
                    upto += n
                    blobs.append(whole.tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(c, type=pa.int64()) for c in (n_tokens, n_sequences, [task] * len(blobs), before)],
                                                  pa.array(blobs, type=pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def bits_for(n: int) -> int:
    """b such that 2^b is the least power of two, 4 at least, that holds n numbers."""
    return max(2, (n - 1).bit_length() if n > 1 else 0)


def permute(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of numbers among 0 .. n - 1: a Feistel network of two unequal halves that trade places, with cycle-walking."""
    low = bits_for(n) // 2
    high = bits_for(n) - low

    def network(x: np.ndarray) -> np.ndarray:
        a, b = high, low  # bits of the left and of the right half
        for r in range(ROUNDS):
            left, right = x >> np.uint64(b), x & np.uint64((1 << b) - 1)
            changed = left ^ (mix(right + mix(np.full(1, key % 2**64, dtype=np.uint64) + np.uint64(r))) & np.uint64((1 << a) - 1))
            x, a, b = right << np.uint64(a) | changed, b, a
        return x

    x = network(numbers.astype(np.uint64))
    outside = np.flatnonzero(x >= np.uint64(n))
    while len(outside):
        x[outside] = network(x[outside])
        outside = outside[x[outside] >= np.uint64(n)]
    return x.astype(np.int64)


def in_training_order(texts: DataFrame, key: int, token_bytes: int, length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """(shard, slot, id, sequence, n_tokens, tokens) of rows of ``encoded`` (read back), in ranges of shards and sorted by slot."""
    width = length * token_bytes
    totals = texts.groupBy("task").agg(F.sum("n_sequences").alias("n"))
    upto = W.orderBy("task").rowsBetween(W.unboundedPreceding, 0)  # one row a task
    offs = stage(totals.select("task", F.sum("n").over(upto).alias("upto"), "n").select("task", (F.col("upto") - F.col("n")).alias("off"), "upto"), "offsets")
    n = offs.agg(F.max("upto")).first()[0] or 0
    based = texts.join(offs.select("task", "off"), "task").withColumn("base", F.col("off") + F.col("before")).select("id", "n_tokens", "base", "tokens")
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("slot", T.LongType()), texts.schema["id"], T.StructField("sequence", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                blobs = part.column("tokens").to_pylist()
                count = np.array([len(x) // width for x in blobs], dtype=np.int64)
                row = np.repeat(np.arange(part.num_rows), count)
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                slot = permute(part.column("base").to_numpy()[row] + place, n, key)
                held = np.clip(part.column("n_tokens").to_numpy()[row] - place * length, 0, length)
                yield pa.RecordBatch.from_arrays([pa.array(slot // stride), pa.array(slot), part.column("id").take(pa.array(row)), pa.array(place), pa.array(held),
                                                  pa.array([blobs[i][p * width:(p + 1) * width] for i, p in zip(row.tolist(), place.tolist(), strict=True)], type=pa.binary())], names=schema.names)

    shards = -(-n // stride)
    tasks = max(1, min(shards, max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_A_TASK))))
    rows = based.mapInArrow(run, schema)
    if shards:
        rows = rows.repartitionById(tasks, F.expr(f"cast(shard * {tasks} div {shards} as int)"))
    return rows.sortWithinPartitions("shard", "slot")  # the order that the writer by shard asks for


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of ``write_shards``; ``like`` gives the columns, as an empty corpus leaves no file to tell them."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_shards(sequences: DataFrame, path: str) -> None:
    """Write the rows of ``in_training_order`` below ``path``: one folder and file per shard, rows by slot."""
    sequences.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def resume(spark: SparkSession, path: str, slot: int, stride: int = STRIDE) -> DataFrame:
    """The rows from a slot on, in order: later shards whole, of the slot's own shard what is left."""
    return spark.read.parquet(path).filter((F.col("shard") >= slot // stride) & (F.col("slot") >= slot)).orderBy("slot")
