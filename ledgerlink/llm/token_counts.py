"""Token counts of sections by offset-mapped attribution.

Each whole text is encoded once.  A token covers the characters whose bytes it holds, which gives spans of the text in order; sections
(here: the lines of a text, or any fields put together with ``joined_fields``) are spans too.  The two sorted lists meet in an interval
join inside the row that holds both, so nothing is shuffled and a text's tokens never leave its task.

A token that crosses sections is allocated by the rule that is asked for:
``first``: to the section that holds its first byte; ``last``: its last byte; ``most``: most of its bytes (the first of equal ones);
``split``: to each section in thousandths by its share of bytes, rounded down, the rest to the section with its first byte.
Whatever the rule, the sections' counts add up to the tokens of the whole text.

Defined results.  Null text counts as empty.  A text has one section more than line ends; the line end belongs to the line it ends.  An empty text has one section
without tokens.  Repeated rows each have their sections; null or repeated ids are carried as they are.  Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.byte_bpe import read_ranks

RULES = ("first", "last", "most", "split")
ROWS = 256


def line_bounds(data: bytes) -> np.ndarray:
    """Where the lines of a text begin, in bytes, and its end."""
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return np.concatenate([[0], ends, [len(data)]]).astype(np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Thousandths of tokens of each section: tokens and sections are spans in order, tokens without gaps."""
    n = len(bounds) - 1
    counts = np.zeros(n, dtype=np.int64)
    # an empty section holds no byte: side="right" leads past it
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    if rule == "last":
        np.add.at(counts, last, 1000)
        return counts
    inside = first == last
    np.add.at(counts, first[inside] if rule != "first" else first, 1000)
    if rule == "first":
        return counts
    for t in np.flatnonzero(~inside).tolist():
        sections = np.arange(first[t], last[t] + 1)
        held = np.minimum(bounds[sections + 1], ends[t]) - np.maximum(bounds[sections], starts[t])
        if rule == "most":
            counts[sections[np.argmax(held)]] += 1000
        else:
            share = 1000 * held // (ends[t] - starts[t])
            share[0] += 1000 - share.sum()
            counts[sections] += share
    return counts


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "most", bounds_col: str | None = None) -> DataFrame:
    """One row per section: id, section, start, end (bytes), tokens (thousandths), text_tokens.

    ``bounds_col``: an array<bigint> of section bounds in bytes (see ``joined_fields``) in place of the lines.
    The rank file is read by the driver and broadcast; a vocabulary is a fixed file of about a megabyte."""
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {RULES}")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), (F.col(f"`{bounds_col}`") if bounds_col else F.lit(None)).cast("array<bigint>").alias("bounds"))
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = T.StructType([rows.schema["id"], *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("starts", "ends", "tokens")], T.StructField("text_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        tokens = shared.value
        length = np.array([len(t) for t in tokens], dtype=np.int64)
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                out: list[list[np.ndarray]] = [[], [], []]
                totals = []
                for text, given in zip(part.column("text").to_pylist(), part.column("bounds").to_pylist(), strict=True):
                    data = (text or "").encode()
                    ids = np.array(encoding.encode_ordinary(text or ""), dtype=np.int64)
                    ends = np.cumsum(length[ids])
                    bounds = line_bounds(data) if given is None else np.array([0, *given, len(data)], dtype=np.int64)
                    for column, values in zip(out, (bounds[:-1], bounds[1:], allocate(ends - length[ids], ends, bounds, rule)), strict=True):
                        column.append(values)
                    totals.append(len(ids))
                offsets = pa.array(np.cumsum([0, *map(len, out[0])]), type=pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c), type=pa.int64())) for c in out],
                                                  pa.array(totals, type=pa.int64())], names=schema.names)

    found = rows.mapInArrow(run, schema)
    return (found.select("id", "text_tokens", F.posexplode(F.arrays_zip("starts", "ends", "tokens")).alias("section", "s"))
            .select("id", "section", F.col("s.starts").alias("start"), F.col("s.ends").alias("end"), F.col("s.tokens").alias("tokens"), "text_tokens"))


def joined_fields(fields: list[Column]) -> tuple[Column, Column]:
    """(text, bounds) of fields written one after the other, for ``section_tokens``: section i is field i; null counts as empty."""
    parts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    ends, upto = [], F.lit(0)
    for p in parts[:-1]:
        upto = upto + F.octet_length(p)
        ends.append(upto.cast("long"))
    return F.concat(*parts), F.array(*ends).cast("array<bigint>")
