"""Entity resolution batch by batch, over a stored state.

Links never leave a block: equal names have the same block, fuzzy partners too, and a row with a blank name stands by itself.  So a batch
changes the entities of the blocks that it has rows in, and no others.  The state keeps the lists' rows and the entities, both partitioned by a
hash of the block; a batch reads the partitions of its blocks, resolves those blocks from old and new rows, and replaces their entities.

    <state>/rows_s1, rows_s2   rows as they came, by part and batch (a batch that runs again replaces its own rows)
    <state>/entities           the entities of all blocks, by part

A batch that ends midway leaves entities as they were or as they shall be in each part; run again, it gives the same state.  One writer
at a time.  Entities equal those of one run over the rows of all batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.functions.text import block_key
from ledgerlink.operators import linkage
from ledgerlink.sources.store import _folder_exists, stage

#: Partitions of the state unless said otherwise; the driver gets the numbers of those that a batch touches.
PARTS = 256
BLOCK, PART, BATCH = "state_block", "state_part", "state_batch"


def _block(clean: Column, row_id: Column, block_chars: int) -> Column:
    return F.when(clean == "", F.concat(F.lit("#"), row_id)).otherwise(block_key(clean, block_chars))


def _part(block: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(parts)).cast("int")


def _with_block(rows: DataFrame, sfx: str, block_chars: int, parts: int = PARTS) -> DataFrame:
    """The rows as they are, with their block and part."""
    prepare = linkage.prepare_source1 if sfx == "s1" else linkage.prepare_source2
    block = _block(F.col(f"clean_name_{sfx}"), F.col(f"row_id_{sfx}"), block_chars)
    prepared = prepare(rows, block_chars)
    own = [F.col(c if c in prepared.columns else f"{c}_{sfx}").alias(c) for c in rows.columns]
    return prepared.select(*own, block.alias(BLOCK)).withColumn(PART, _part(F.col(BLOCK), parts))


def _write(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``rows`` has."""
    (rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path))


def touched_rows(spark: SparkSession, path: str, like: DataFrame, blocks: DataFrame, parts: list[int], batch: str) -> DataFrame:
    """The stored rows of other batches in ``blocks``: only their partitions are read."""
    if not _folder_exists(spark, path):
        return like.limit(0).drop(PART)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in like.schema.fields if f.name != PART)}, {PART} int, {BATCH} string"
    rows = spark.read.schema(schema).parquet(path).filter(F.col(PART).isin(parts) & (F.col(BATCH) != batch))
    return rows.join(blocks, BLOCK, "left_semi").select(*[c for c in like.columns if c != PART])


def resolve_batch(spark: SparkSession, state: str, source1: DataFrame, source2: DataFrame, batch: str, threshold: float = 85.0,
                  block_chars: int = 6, pairs_per_task: int | None = linkage.DEFAULT_PAIRS_PER_TASK, parts: int = PARTS) -> DataFrame:
    """Add a batch to the state; the entities of the blocks it touches.  Later batches must use the same threshold, block_chars and parts."""
    new = {s: stage(_with_block(rows, s, block_chars, parts), f"batch-{s}") for s, rows in (("s1", source1), ("s2", source2))}
    blocks = stage(new["s1"].select(BLOCK, PART).unionByName(new["s2"].select(BLOCK, PART)).distinct(), "blocks")
    touched = sorted(r[0] for r in blocks.select(PART).distinct().collect())  # as many numbers as the state has parts, at most
    sides = []
    for sfx, rows in new.items():
        own = rows.drop(PART)
        sides.append(touched_rows(spark, f"{state}/rows_{sfx}", rows, blocks.select(BLOCK), touched, batch).unionByName(own).drop(BLOCK))
    found = linkage.resolve_entities(*sides, threshold, block_chars, pairs_per_task=pairs_per_task)
    name, row_id = F.coalesce("clean_name_s1", "clean_name_s2"), F.coalesce("row_id_s1", "row_id_s2")
    found = stage(found.withColumn(BLOCK, _block(name, row_id, block_chars)).withColumn(PART, _part(F.col(BLOCK), parts)), "entities")

    for sfx, rows in new.items():
        if touched:
            _write(rows.withColumn(BATCH, F.lit(batch)), f"{state}/rows_{sfx}", PART, BATCH)
    kept = found
    if _folder_exists(spark, f"{state}/entities"):
        others = spark.read.schema(found.schema).parquet(f"{state}/entities").filter(F.col(PART).isin(touched)).join(blocks.select(BLOCK), BLOCK, "left_anti")
        kept = stage(found.unionByName(others.select(*found.columns)), "parts")  # what is replaced can't be read meanwhile
    if touched:
        _write(kept, f"{state}/entities", PART)
    return found.drop(BLOCK, PART)


def read_entities(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(f"{state}/entities").drop(BLOCK, PART).select(*linkage.ENTITY_COLUMNS)
