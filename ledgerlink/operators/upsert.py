"""Keyed upsert (MERGE semantics) as one full outer join on the key.

matched     -> staged values for ``update_columns`` (default: every non-key column),
               target values for the rest
not matched -> staged row inserted
target only -> kept (never deleted)

One shuffle of each side on the key; the output stays hash-partitioned on the key, so
the writer needs no further exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.schemas import REGISTRY_KEY


class DuplicateKeyError(Exception):
    """Staged rows carry the same key more than once; a MERGE would be ambiguous."""


def duplicate_keys(df: DataFrame, key: str = REGISTRY_KEY) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def assert_unique_keys(df: DataFrame, key: str = REGISTRY_KEY) -> None:
    if not duplicate_keys(df, key).isEmpty():
        raise DuplicateKeyError(f"staged rows repeat {key}; dedupe before upsert")


def keep_one_per_key(df: DataFrame, order_by: Sequence[str], key: str = REGISTRY_KEY) -> DataFrame:
    """Deterministic dedupe: per key keep the row with the smallest ``order_by`` tuple.
    A min(struct) aggregate, so a hot key is combined map-side, not sorted in one task."""
    rest = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c) for c in rest])
    return df.groupBy(key).agg(F.min(packed).alias("_w")).select(key, *[f"_w.{c}" for c in rest]) \
        .select(*df.columns)


def merge_upsert(target: DataFrame, staged: DataFrame, key: str = REGISTRY_KEY,
                 update_columns: Sequence[str] | None = None, newer_by: str | None = None) -> DataFrame:
    """Result of ``MERGE INTO target USING staged ON key`` (update matched, insert new).

    ``newer_by``: matched rows are updated only where the staged row isn't older by this column
    (NULL is older than any value), so batches that arrive late or twice change nothing."""
    columns = target.columns
    missing = [c for c in columns if c not in staged.columns]
    if missing:
        raise ValueError(f"staged rows lack registry columns {missing}")
    update = set(update_columns) if update_columns is not None else {c for c in columns if c != key}
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in columns])
    s = staged.select(*[F.col(c).alias(f"s__{c}") for c in columns])
    joined = t.join(s, F.col(f"t__{key}") == F.col(f"s__{key}"), "full_outer")
    in_staged = F.col(f"s__{key}").isNotNull()
    if newer_by:
        mine, its = F.col(f"s__{newer_by}"), F.col(f"t__{newer_by}")
        in_staged = in_staged & (F.col(f"t__{key}").isNull() | its.isNull() | F.coalesce(mine >= its, F.lit(False)))
    in_target = F.col(f"t__{key}").isNotNull()
    out = []
    for c in columns:
        if c == key:
            expr = F.coalesce(F.col(f"s__{key}"), F.col(f"t__{key}"))
        elif c in update:
            expr = F.when(in_staged, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}"))
        else:
            expr = F.when(in_target, F.col(f"t__{c}")).otherwise(F.col(f"s__{c}"))
        out.append(expr.alias(c))
    return joined.select(*out)


def merge_upsert_legacy(target: DataFrame, staged: DataFrame, key: str = REGISTRY_KEY) -> DataFrame:
    """Older merge: updates every column except ``match_type`` (kept stale on update)."""
    return merge_upsert(target, staged, key, [c for c in target.columns if c not in (key, "match_type")])


def upsert_actions(target: DataFrame, staged: DataFrame, key: str = REGISTRY_KEY) -> DataFrame:
    """Per staged key: 'update' or 'insert' (a left outer join, no target-only rows)."""
    tk = target.select(F.col(key).alias("_tk")).distinct()
    return (staged.select(key).join(tk, F.col(key) == F.col("_tk"), "left")
            .select(key, F.when(F.col("_tk").isNotNull(), "update").otherwise("insert").alias("action")))


def stale_rows(registry: DataFrame, staged: DataFrame, key: str = REGISTRY_KEY) -> DataFrame:
    """Registry rows the latest batch no longer produces (the merge keeps them): e.g. a
    list-2-only entity that is now linked fuzzily under its list-1 partner's key."""
    return registry.join(staged.select(key), key, "left_anti")
