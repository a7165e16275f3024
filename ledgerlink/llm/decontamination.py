"""Benchmark decontamination by winnowing.

1. Each text is cut into words; of the hashes of its runs of ``K`` words, the least of every ``WINDOW - K + 1``
   consecutive ones is kept as a fingerprint (the rightmost of equal ones).  Any ``WINDOW`` consecutive
   words that two texts share contain the same such run of hashes, hence one fingerprint of both: no shared
   span of ``WINDOW`` words is missed.  An item of fewer words is one window; its hash is sought
   at every place, for each such length that the benchmark holds.
2. Documents keep only fingerprints that pass a bit filter of fixed size (``FILTER_BITS``) of the benchmark's,
   each with the hashes of the ``WINDOW - K`` words on either side.
3. Document and benchmark fingerprints are joined on the hash, and each meeting is extended to both sides word
   by word; spans of ``WINDOW`` equal words or more are hits.  Nothing but the filter is broadcast by hand.

Rows are identified by (id, hash of the text), so an id may be null or repeat: rows with the same id and
different texts are judged apart, equal rows alike.  Null or empty text has no words and is clean; so is every
row when the benchmark is empty.  A null item id counts as an item of its own without a name in the list of ids.
Extra columns are kept and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerlink.llm.frames import fresh, stage, text_hash
from ledgerlink.llm.wordgrams import ALNUM, chunks, gram_hashes, word_hashes

WINDOW = 13
K = 6
FILTER_BITS = 1 << 24
#: A row is contaminated when hit words are this share of its words (1 of 20) or more.
SHARE = 20

_PRINT = "array<struct<hash:bigint,length:int,at:bigint,near:binary>>"


def _fingerprints(words: np.ndarray, rows: np.ndarray, window: int, k: int) -> np.ndarray:
    """Places of the winnowed runs of k words; each window of one row contributes its rightmost least."""
    grams, whole = gram_hashes(words, rows, k)
    w = window - k + 1
    if len(grams) < w:
        return np.empty(0, np.int64)
    grams = np.where(whole, grams, np.uint64(2**64 - 1))
    view = np.lib.stride_tricks.sliding_window_view(grams, w)
    least = np.arange(len(view)) + (w - 1 - np.argmin(view[:, ::-1], axis=1))
    first = np.arange(len(view))
    row_end = np.repeat(rows[1:], np.diff(rows))[:len(view)]
    return np.unique(least[first + window <= row_end])


def _context(words: np.ndarray, rows: np.ndarray, places: np.ndarray, window: int, k: int) -> np.ndarray:
    """For each place, the hashes from window - k words before to as many after its run; 0 beyond the row."""
    side = window - k
    row = np.searchsorted(rows, places, "right") - 1
    at = places[:, None] + np.arange(-side, k + side)
    inside = (at >= rows[row][:, None]) & (at < rows[row + 1][:, None])
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))


def _as_prints(found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int, np.ndarray | None]], n_rows: int) -> pa.Array:
    """A list column from (row, place in row, hash, length, context) parts."""
    if not found:
        return pa.array([[]] * n_rows, type=pa.list_(pa.struct([("hash", pa.int64()), ("length", pa.int32()), ("at", pa.int64()), ("near", pa.binary())])))
    row = np.concatenate([f[0] for f in found])
    order = np.argsort(row, kind="stable")
    near = [x for f in found for x in ([c.tobytes() for c in f[4]] if f[4] is not None else [None] * len(f[0]))]
    values = pa.StructArray.from_arrays([
        pa.array(np.concatenate([f[2] for f in found])[order].view(np.int64)),
        pa.array(np.concatenate([np.full(len(f[0]), f[3], np.int32) for f in found])[order]),
        pa.array(np.concatenate([f[1] for f in found])[order].astype(np.int64)),
        pa.array([near[i] for i in order], type=pa.binary())], names=["hash", "length", "at", "near"])
    bounds = np.searchsorted(row[order], np.arange(n_rows + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), values)


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(8)) % np.uint64(FILTER_BITS)


def _prints_of(column: pa.Array, window: int, k: int, short: list[int] | None, bits: np.ndarray | None) -> tuple[np.ndarray, pa.Array]:
    """(number of words, fingerprints) of each row.  ``short`` None: the rows are benchmark items."""
    n_words, found = [], []
    for first, _, data, bounds in chunks(column):
        words, rows = word_hashes(data, bounds, ALNUM)
        count = np.diff(rows)
        n_words.append(count)

        def keep(places: np.ndarray, hashes: np.ndarray, length: int, rows=rows, words=words, first=first) -> None:
            if bits is not None:
                passed = (bits[_bit(hashes) >> np.uint64(3)] >> (_bit(hashes) & np.uint64(7)).astype(np.uint8)) & 1
                places, hashes = places[passed > 0], hashes[passed > 0]
            if len(places):
                row = np.searchsorted(rows, places, "right") - 1
                found.append((row + first, places - rows[row], hashes, length, _context(words, rows, places, window, k) if length == k else None))

        places = _fingerprints(words, rows, window, k)
        if len(places):
            keep(places, gram_hashes(words, rows, k)[0][places], k)
        # windows of fewer words carry their length with a minus sign, as K itself may be one of them
        for length in (sorted(set(count[(count > 0) & (count < window)].tolist())) if short is None else short):
            grams, whole = gram_hashes(words, rows, length)
            at = rows[:-1][count == length] if short is None else np.flatnonzero(whole)
            keep(at, grams[at] ^ np.uint64(0x5851F42D4C957F2D), -length)
    return (np.concatenate(n_words) if n_words else np.empty(0, np.int64)), _as_prints(found, len(column))


def _with_prints(rows: DataFrame, text: str, window: int, k: int, short: list[int] | None, bits: bytes | None) -> DataFrame:
    """``rows`` without ``text``, with n_words and prints."""
    kept = [c for c in rows.columns if c != text]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("n_words", T.LongType()),
                           T.StructField("prints", T.ArrayType(T.StructType([
                               T.StructField("hash", T.LongType()), T.StructField("length", T.IntegerType()),
                               T.StructField("at", T.LongType()), T.StructField("near", T.BinaryType())])))])
    shared = rows.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, dtype=np.uint8) if shared is not None else None
        for b in batches:
            n_words, prints = _prints_of(b.column(text), window, k, short, table)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(n_words, type=pa.int64()), prints], names=[*kept, "n_words", "prints"])

    return rows.mapInArrow(run, schema)


def _filter_bits(prints: DataFrame) -> bytes:
    """The fixed-size bit filter of the benchmark's hashes: FILTER_BITS / 8 bytes whatever its size."""
    bit = F.expr(f"pmod(shiftrightunsigned(hash, 8), {FILTER_BITS}) + 1")  # Spark's buckets count from 1
    parts = (prints.select(bit.alias("bit"))
             .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for p in parts:
        out[(p["bucket"] - 1) * 4096:p["bucket"] * 4096] = np.frombuffer(bytes(p["bits"]), dtype=np.uint8)
    return out.tobytes()


def _extend(pairs: DataFrame, window: int, k: int) -> DataFrame:
    """The hit span (start, end) of each meeting that reaches ``window`` equal words."""
    side = window - k
    kept = [c for c in pairs.columns if c not in ("near", "item_near", "at", "length")]
    schema = T.StructType([*[pairs.schema[c] for c in kept], T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, at = b.column("length").to_numpy(zero_copy_only=False), b.column("at").to_numpy(zero_copy_only=False)
            start, end, good = at.copy(), at - length, length < 0
            long = np.flatnonzero(length > 0)
            if len(long):
                def near(name: str, long=long, b=b) -> np.ndarray:
                    return np.frombuffer(b"".join(b.column(name).take(pa.array(long)).to_pylist()), dtype=np.uint64).reshape(len(long), k + 2 * side)

                mine, its = near("near"), near("item_near")
                same = (mine == its) & (mine != 0)
                run_left = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
                run_right = np.cumprod(same[:, side + k:], axis=1).sum(axis=1)
                ok = same[:, side:side + k].all(axis=1) & (run_left + k + run_right >= window)
                start[long], end[long], good[long] = at[long] - run_left, at[long] + k + run_right, ok
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(pa.array(keep)) for c in kept],
                                              pa.array(start[keep], type=pa.int64()), pa.array(end[keep], type=pa.int64())], names=[*kept, "start", "end"])

    return pairs.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_words, spans (array of hit spans, disjoint, in order),
    items (ids as strings, sorted), n_hit, n_items, contaminated."""
    bench = items.select(F.col(f"`{item_id_col}`").cast("string").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    theirs = _with_prints(bench, "text", window, k, None, None)
    theirs = stage(theirs.select("item_id", F.explode("prints").alias("p")).select("item_id", "p.hash", "p.length", F.col("p.near").alias("item_near")).distinct(), "bench")
    short = sorted(-r["length"] for r in theirs.filter("length < 0").select("length").distinct().collect())  # at most window - 1 rows
    mine = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    prints = stage(_with_prints(mine, "text", window, k, short, _filter_bits(theirs)), "prints")
    met = (prints.select("id", "text_hash", F.explode("prints").alias("p")).select("id", "text_hash", "p.*").distinct()
           .join(theirs, ["hash", "length"]).drop("hash"))
    hits = stage(_extend(met, window, k).distinct(), "hits")
    before = F.max("end").over(W.partitionBy("id", "text_hash").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    # a span that begins inside or at the end of the spans before it adds the words beyond them
    fresh_from = F.greatest("start", F.coalesce(before, F.lit(0)))
    added = F.greatest(F.col("end") - fresh_from, F.lit(0))
    per_doc = (hits.select("id", "text_hash", "start", "end").distinct().withColumn("added", added).withColumn("from", fresh_from)
               .groupBy("id", "text_hash").agg(F.sum("added").alias("n_hit"), F.sort_array(F.collect_list(F.when(F.col("added") > 0, F.struct(F.col("from").alias("start"), F.col("end"))))).alias("spans")))
    per_item = (hits.select("id", "text_hash", "item_id").distinct().groupBy("id", "text_hash")
                .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items")))
    d = prints.select("id", "text_hash", "n_words").alias("d")
    for name, side in (("h", per_doc), ("i", per_item)):
        d = d.join(side.alias(name), F.col("d.id").eqNullSafe(F.col(f"{name}.id")) & (F.col("d.text_hash") == F.col(f"{name}.text_hash")), "left")
    n_hit = F.coalesce(F.col("h.n_hit"), F.lit(0)).cast("long")
    return d.select(
        F.col("d.id").alias("id"), F.col("d.text_hash").alias("text_hash"), "n_words",
        F.coalesce(F.col("h.spans"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")).alias("spans"),
        F.coalesce(F.col("i.items"), F.array().cast("array<string>")).alias("items"),
        n_hit.alias("n_hit"), F.coalesce(F.col("i.n_items"), F.lit(0)).cast("long").alias("n_items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    bad = contamination(docs, items, id_col, text_col).filter("contaminated")
    bad_id, bad_hash = fresh(docs, "_bad_id"), fresh(docs, "_bad_hash")
    bad = bad.select(F.col("id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    same = docs[id_col].eqNullSafe(bad[bad_id]) & (text_hash(docs[text_col]) == bad[bad_hash])
    return docs.join(bad, same, "left_anti")
