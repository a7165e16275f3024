"""Entity linkage: exact clean-name links, blocked fuzzy links, leftovers.

Plan shape (all declarative, Catalyst picks the physical joins):

1. prepare: clean name, clean address, block key, content row id per input row.
2. collapse each side to one row per clean name (names with very long lists in all are aggregated by
   name and list item first, so a name carried by a third of all rows costs its distinct items, not its rows).
   Rows with a blank clean name cannot be linked; they collapse per identical content.
3. exact links and what is left: one full outer join on the name, 1:1 by construction.
4. fuzzy links between still-unlinked names: equi-join on the block, on (block, length band) or, where blocks are
   large, on (block, indexed character), with
   the exact partner-length window and a character signature as residual conditions.  All of
   it is exact pruning (``pruned_pairs``): a pair can only reach the threshold if it has
   threshold*(la+lb)/200 characters in common.  Keys holding more pairs than a per-task
   budget are split into a salt grid.  Scores are native bit-parallel LCS; the best partner
   per list-1 name is a min(struct) aggregate (no window, no hot sort).
5. leftovers: one-sided rows of the same join without a partner.

Every output row is one entity; ``corporate_id`` is unique by construction.
``link_rows`` maps every input row to its entity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.similarity import lcs_length_arrow, lcs_sql, token_sort_ratio_from_lcs
from ledgerlink.functions.text import LIST_DELIMITER, block_key, clean_name, normalize_address, parse_list, sort_tokens
from ledgerlink.operators import pruning
from ledgerlink.operators.matching import stable_partners

S1_RAW = ["corporate_name_s1", "address", "activity_places", "top_suppliers"]
S2_RAW = ["corporate_name_s2", "main_customers", "revenue", "profit"]
S1_PAYLOAD = ["corporate_name_s1", "address", "clean_address_s1", "activity_places", "top_suppliers",
              "batch_id_s1"]
S2_PAYLOAD = ["corporate_name_s2", "main_customers", "revenue", "profit", "batch_id_s2"]
LINEAGE = ("source_name", "batch_id", "ingestion_ts")

ENTITY_COLUMNS = (["corporate_id", "canonical_name", "match_type", "match_confidence", "name_score",
                   "clean_name_s1", "clean_name_s2", "row_id_s1", "row_id_s2", "n_rows_s1", "n_rows_s2"]
                  + S1_PAYLOAD + S2_PAYLOAD)


# --------------------------------------------------------------------------- prepare

def _field(c: Column) -> Column:
    """Length-prefixed encoding: unambiguous concatenation, NULL distinct from ''."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.char_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def content_id(tag: str, cols: list[Column]) -> Column:
    """Deterministic row id from row content (same row -> same id on any partitioning)."""
    return F.sha2(F.concat_ws("|", F.lit(tag), *[_field(c) for c in cols]), 256)


def _money_text(c: str) -> Column:
    """Text that tells any two money values apart: six decimals where they say the value
    exactly, else the value's own text (which also separates NaN, infinities and NULL)."""
    return F.expr(f"CASE WHEN cast(try_cast(`{c}` AS DECIMAL(38,6)) AS DOUBLE) = try_cast(`{c}` AS DOUBLE) "
                  f"THEN cast(try_cast(`{c}` AS DECIMAL(38,6)) AS STRING) ELSE cast(`{c}` AS STRING) END")


def _with_lineage(df: DataFrame, suffix: str) -> DataFrame:
    for c in LINEAGE:
        df = (df.withColumnRenamed(c, f"{c}_{suffix}") if c in df.columns
              else df.withColumn(f"{c}_{suffix}", F.lit(None).cast("string")))
    return df


def prepare_source1(df: DataFrame, block_chars: int = 6) -> DataFrame:
    df = _with_lineage(df, "s1")
    return df.withColumns({
        "clean_name_s1": clean_name("corporate_name_s1"),
        "clean_address_s1": normalize_address("address"),
        "row_id_s1": content_id("s1", [F.col(c) for c in S1_RAW]),
    }).withColumn("name_block_s1", block_key("clean_name_s1", block_chars))


def prepare_source2(df: DataFrame, block_chars: int = 6) -> DataFrame:
    df = _with_lineage(df, "s2")
    return df.withColumns({
        "clean_name_s2": clean_name("corporate_name_s2"),
        "row_id_s2": content_id("s2", [F.col("corporate_name_s2"), F.col("main_customers"),
                                       _money_text("revenue"), _money_text("profit")]),
    }).withColumn("name_block_s2", block_key("clean_name_s2", block_chars))


# --------------------------------------------------------------------------- collapse

#: Names whose rows hold more characters of lists than this (and ROW_CHARS for each row) are taken apart item by item.
HOT_CHARS, ROW_CHARS = 1 << 15, 64


def collapse_side(prepared: DataFrame, sfx: str, match_blank: bool = False, hot_chars: int = HOT_CHARS) -> DataFrame:
    """One row per clean name, and one per distinct content among blank-name rows, keeping
    what every row says:

    lists     union of the items of all rows, sorted (NULL if no row has the list)
    figures   revenue and profit of the row with the greatest revenue, then profit (NaN as NULL)
    address   the least address that isn't blank; name: the least spelling
    row id    the least; batch: the least

    The rows are written once.  A name's lists meet as they are and are taken apart there: one
    exchange of the rows.  Names with more than ``hot_chars`` characters of lists go another way,
    two aggregates: by (name, list, item), then by name.  Each row is one row for its own
    values (list 0) and one for each item of its lists.  Equal items and own values combine
    in the map tasks and then by item, so a name carried by a third of all rows, each with
    another list, costs a task no more than its distinct items, once each.  These make up
    one value of the result, which is the only thing that grows with them.  Hot names are
    found by a hash, whose collisions only send more names the longer way; the driver learns
    whether there are any.  The rows themselves stay reachable through ``link_rows``."""
    clean, row_id = F.col(f"clean_name_{sfx}"), F.col(f"row_id_{sfx}")
    blank_id = (F.lit(None).cast("string") if match_blank else F.when(clean == "", row_id)).alias("_blank_id")
    number = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    if sfx == "s1":
        lists = ["activity_places", "top_suppliers"]
        least = {"corporate_name_s1": F.col("corporate_name_s1"), "address": F.when(F.trim("address") != "", F.col("address")), "batch_id_s1": F.col("batch_id_s1")}
        greatest = {}
    else:
        lists = ["main_customers"]
        least = {"corporate_name_s2": F.col("corporate_name_s2"), "batch_id_s2": F.col("batch_id_s2")}
        greatest = {"_figures": F.struct(number("revenue"), number("profit"))}
    least[f"row_id_{sfx}"] = row_id
    keys, own = [f"clean_name_{sfx}", "_blank_id"], F.struct(*[v.alias(c) for c, v in {**least, **greatest}.items()]).alias("_own")
    rows = cut_lineage(prepared.select(clean, blank_id, *lists, own), f"rows-{sfx}")
    chars = F.lit(ROW_CHARS) + sum(F.coalesce(F.char_length(c), F.lit(0)) for c in lists)
    name_hash = F.xxhash64(*keys).alias("_hash")
    hot = cut_lineage(rows.groupBy(name_hash).agg(F.sum(chars).alias("chars")).filter(F.col("chars") > F.lit(int(hot_chars))).select("_hash"), f"hot-{sfx}")
    if hot.isEmpty():
        out = _collapsed(rows, keys, lists, least, greatest, sfx)
    else:
        hashed = rows.withColumn("_hash", name_hash)
        out = _collapsed(hashed.join(hot, "_hash", "left_anti"), keys, lists, least, greatest, sfx).unionByName(
            _collapsed_by_item(hashed.join(hot, "_hash", "left_semi"), keys, lists, least, greatest, sfx))
    out = out.withColumns({c: F.when(F.col(f"_has_{c}"), F.array_join(c, "|")) for c in lists})
    if sfx == "s1":
        out = out.withColumn("clean_address_s1", normalize_address("address"))
    else:
        out = out.withColumns({"revenue": F.col("_figures.revenue"), "profit": F.col("_figures.profit")})
    return out.select(f"clean_name_{sfx}", f"n_rows_{sfx}", f"row_id_{sfx}", *(S1_PAYLOAD if sfx == "s1" else S2_PAYLOAD))


def _collapsed(rows: DataFrame, keys: list[str], lists: list[str], least, greatest, sfx: str) -> DataFrame:
    """Names whose lists fit a task many times over: their rows meet once, before they are aggregated."""
    out = rows.repartition(*keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"n_rows_{sfx}"), *[F.min(f"_own.{c}").alias(c) for c in least], *[F.max(f"_own.{c}").alias(c) for c in greatest],
        *[F.max(F.col(c).isNotNull()).alias(f"_has_{c}") for c in lists], *[F.collect_list(c).alias(c) for c in lists])
    # joined in a step of its own, so that the text is made once for the tests and the split of ``parse_list``
    out = out.withColumns({c: F.array_join(c, LIST_DELIMITER) for c in lists})
    return out.withColumns({c: F.sort_array(F.array_distinct(parse_list(c))) for c in lists})


def _collapsed_by_item(rows: DataFrame, keys: list[str], lists: list[str], least, greatest, sfx: str) -> DataFrame:
    """Names of any number of rows: equal items combine before a name's distinct items meet."""
    given = {f"_has_{c}": F.col(c).isNotNull() for c in lists}
    own = F.struct(F.col("_own.*"), *[v.alias(c) for c, v in given.items()])
    entry = lambda k, item, own: F.struct(F.lit(k).alias("list"), item.alias("item"), own.alias("own"))
    items_of = lambda k, c: F.transform(F.array_distinct(parse_list(c)), lambda x: entry(k, x, F.when(F.lit(False), F.col("_o"))))
    entries = F.concat(F.array(entry(0, F.lit(None).cast("string"), F.col("_o"))), *[items_of(k, c) for k, c in enumerate(lists, 1)])
    exploded = rows.select(*keys, *lists, own.alias("_o")).select(*keys, F.explode(entries).alias("_e"))
    scalars = lambda at: [*[F.min(F.col(at + c)).alias(c) for c in least], *[F.max(F.col(at + c)).alias(c) for c in [*greatest, *given]]]
    items = exploded.groupBy(*keys, F.col("_e.list").alias("_list"), F.col("_e.item").alias("_item")).agg(
        F.count_if(F.col("_e.list") == 0).alias("_n"), *scalars("_e.own."))
    return items.groupBy(*keys).agg(F.sum("_n").alias(f"n_rows_{sfx}"), *scalars(""), *[
        F.sort_array(F.collect_list(F.when(F.col("_list") == k, F.col("_item")))).alias(c) for k, c in enumerate(lists, 1)])


def named(groups: DataFrame, sfx: str) -> DataFrame:
    return groups.filter(F.col(f"clean_name_{sfx}") != "")


def blank(groups: DataFrame, sfx: str) -> DataFrame:
    return groups.filter(F.col(f"clean_name_{sfx}") == "")


def cut_lineage(df: DataFrame, name: str = "ckpt") -> DataFrame:
    """Write a parquet table into the shared ``spark.checkpoint.dir`` and read it back.

    The plan below runs once (one job, unlike an eager RDD checkpoint which computes it a
    second time to save it), later branches read columnar files with statistics, and a
    lost executor costs no recomputation of the upstream plan."""
    from ledgerlink.sources.store import stage
    return stage(df, name)


# --------------------------------------------------------------------------- exact

def exact_links(names1: DataFrame, names2: DataFrame) -> DataFrame:
    """Names present on both sides (blank names never link)."""
    return (names1.join(names2, names1["clean_name_s1"] == names2["clean_name_s2"], "inner")
            .withColumns({"match_type": F.lit("exact_name"),
                          "match_confidence": F.lit(100.0),
                          "name_score": F.lit(None).cast("double")}))


def unlinked_s1(names1: DataFrame, names2: DataFrame) -> DataFrame:
    return names1.join(names2.select(F.col("clean_name_s2").alias("clean_name_s1")), "clean_name_s1", "left_anti")


def unlinked_s2(names2: DataFrame, names1: DataFrame) -> DataFrame:
    return names2.join(names1.select(F.col("clean_name_s1").alias("clean_name_s2")), "clean_name_s2", "left_anti")


# --------------------------------------------------------------------------- fuzzy

def partner_length_range(length: Column, threshold: float) -> tuple[Column, Column]:
    """[lo, hi]: lengths a partner may have and still reach ``threshold`` (one extra on
    each side, so float rounding at the edge can never drop a passing pair)."""
    t = min(float(threshold), 100.0)  # above 100 nothing passes; the wider range is harmless
    lo = F.greatest((F.floor(length * F.lit(t / (200.0 - t))) - F.lit(1)).cast("int"), F.lit(1))
    hi = F.greatest((F.ceil(length * F.lit((200.0 - t) / t)) + F.lit(1)).cast("int"), F.lit(1))
    return lo, hi


def _fuzzy_keys(names: DataFrame, sfx: str, block_chars: int) -> DataFrame:
    clean = F.col(f"clean_name_{sfx}")
    return (names.select(clean, block_key(clean, block_chars).alias("block"),
                         sort_tokens(clean).alias(f"sorted_{sfx}"))
            .withColumn(f"len_{sfx}", F.char_length(f"sorted_{sfx}")))


DEFAULT_PAIRS_PER_TASK = 1_000_000


def _salt_grid(left: DataFrame, right: DataFrame, keys: list[str], pairs_per_task: int):
    """Split hot keys into a grid of cells holding at most about ``pairs_per_task`` pairs.

    A key with n1*n2 > budget gets k1 = ceil(n1/r) x k2 = ceil(n2/r) cells, r = sqrt(budget):
    a list-1 name goes to row ``hash % k1`` and is copied to every column of it, a list-2
    name goes to column ``hash % k2`` and is copied to every row, so each pair meets in
    exactly one cell.  Replication (n1*k2 + n2*k1) stays far below the n1*n2 pairs it
    spreads.  Only hot keys appear in the grid table; every other key keeps one cell."""
    r = max(1, math.isqrt(int(pairs_per_task)))
    n1 = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n1"))
    n2 = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n2"))
    grid = (n1.join(n2, keys)
            .filter(F.col("_n1").cast("double") * F.col("_n2") > F.lit(int(pairs_per_task)))  # may pass 2^63
            .select(*keys, F.ceil(F.col("_n1") / F.lit(r)).cast("int").alias("_k1"),
                    F.ceil(F.col("_n2") / F.lit(r)).cast("int").alias("_k2")))

    def cells(df: DataFrame, own: str, other: str, own_k: str, other_k: str, name: str) -> DataFrame:
        df = (df.join(grid, keys, "left")
              .withColumn(own_k, F.coalesce(F.col(own_k), F.lit(1)))
              .withColumn(other_k, F.coalesce(F.col(other_k), F.lit(1))))
        return (df.withColumn(own, F.pmod(F.xxhash64(name), F.col(own_k)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_k) - 1)))
                .drop("_k1", "_k2"))

    return (cells(left, "_c1", "_c2", "_k1", "_k2", "clean_name_s1"),
            cells(right, "_c2", "_c1", "_k2", "_k1", "clean_name_s2"),
            [*keys, "_c1", "_c2"])


def _most_pairs(unlinked1: DataFrame, unlinked2: DataFrame, block_chars: int) -> int:
    """Upper bound of the pairs in any one block: two numbers to the driver, from partial counts."""
    blocks = [names.select(F.lit(sfx).alias("side"), block_key(f"clean_name_{sfx}", block_chars).alias("block")) for sfx, names in (("s1", unlinked1), ("s2", unlinked2))]
    most = blocks[0].unionByName(blocks[1]).groupBy("side", "block").agg(F.count(F.lit(1)).alias("n")).groupBy("side").agg(F.max("n").alias("n")).collect()
    return math.prod(r["n"] for r in most) if len(most) == 2 else 0


def candidate_pairs(unlinked1: DataFrame, unlinked2: DataFrame, threshold: float,
                    block_chars: int = 6, pairs_per_task: int | None = DEFAULT_PAIRS_PER_TASK,
                    length_band: int = 4) -> DataFrame:
    """Name pairs sharing a block whose lengths allow the threshold.

    Join key (block, length band): a list-2 name sits in band len // length_band, a list-1
    name is copied to the bands its admissible partner lengths cover (3-5 copies for
    ordinary names) and the exact length window is a residual join condition.  Hot blocks
    are thereby split by length; pairs are exactly those of a block-only join that can pass.

    ``pairs_per_task`` (None = off) additionally splits any (block, band) key holding more
    pairs than that into a grid of cells (``_salt_grid``), so no task scores more than about
    that many pairs of one key, whatever the skew; counts come from two aggregates joined on
    the key, with no driver round trip."""
    w = int(length_band)
    left, right = _fuzzy_keys(unlinked1, "s1", block_chars), _fuzzy_keys(unlinked2, "s2", block_chars)
    if threshold > 0:
        lo, hi = partner_length_range(F.col("len_s1"), threshold)
        left = (left.withColumns({"_lo": lo, "_hi": hi})
                .withColumn("_band", F.explode(F.sequence(F.floor(F.col("_lo") / w).cast("int"),
                                                          F.floor(F.col("_hi") / w).cast("int")))))
    else:  # every pair of a block can pass
        left = left.withColumns({"_lo": F.lit(0), "_hi": F.lit(2**31 - 1), "_band": F.lit(0)})
        w = 2**31 - 1
    right = right.withColumn("_band", F.floor(F.col("len_s2") / w).cast("int"))
    keys = ["block", "_band"]
    if pairs_per_task:
        left, right, keys = _salt_grid(left, right, keys, pairs_per_task)
    pairs = left.join(right, keys, "inner").filter(F.col("len_s2").between(F.col("_lo"), F.col("_hi")))
    return pairs.drop("_band", "_c1", "_c2", "_lo", "_hi")


#: Blocks of up to so many pairs are joined whole: testing the pairs of other lengths costs less than a name's copies for its length bands.
WHOLE_BLOCK_PAIRS = 1 << 16


def pruned_pairs(unlinked1: DataFrame, unlinked2: DataFrame, threshold: float, block_chars: int = 6,
                 pairs_per_task: int | None = DEFAULT_PAIRS_PER_TASK, length_band: int = 4, lcs_engine: str | None = None,
                 whole_block_pairs: int = WHOLE_BLOCK_PAIRS) -> DataFrame:
    """The pairs of ``candidate_pairs`` that have enough characters in common to reach the threshold (see ``pruning``).

    Where no block can hold more than ``whole_block_pairs`` pairs, names meet on the block, each shuffled once; where none can
    hold more than ``pairs_per_task``, on (block, length band).  Otherwise they meet on
    (block, indexed element), where a pair is formed by the first element it shares, and keys that still hold too many are split into a
    grid; shuffled are then a name's copies for its indexed elements, about a quarter of its characters at threshold 85.  Either
    way the length window and the signature are tested in generated code before anything is scored, and the pairs are the same.
    The signatures are made like the scores: in Arrow batches, or by higher-order expressions with the engine 'jvm'."""
    if threshold <= 0:
        return candidate_pairs(unlinked1, unlinked2, threshold, block_chars, pairs_per_task, length_band)
    sides = {}
    for sfx, names in (("s1", unlinked1), ("s2", unlinked2)):
        keys = _fuzzy_keys(names, sfx, block_chars)
        lo, hi = partner_length_range(F.col(f"len_{sfx}"), threshold)
        keys = keys.withColumns({f"_lo_{sfx}": lo, f"_hi_{sfx}": hi})
        if (lcs_engine or DEFAULT_LCS_ENGINE) == "arrow":
            sides[sfx] = keys.withColumn(f"_sig_{sfx}", pruning.signature_arrow(f"sorted_{sfx}"))
        else:
            counts = keys.withColumn("_counts", pruning.occurrences(f"sorted_{sfx}"))
            sides[sfx] = counts.withColumn(f"_sig_{sfx}", pruning.signature("_counts", f"len_{sfx}")).drop("_counts")
    most = _most_pairs(unlinked1, unlinked2, block_chars)
    hot = pairs_per_task and most > pairs_per_task
    formed = F.lit(True)
    if hot:
        for sfx, keys in sides.items():
            index = pruning.index_elements("_elements", F.col(f"len_{sfx}"), F.col(f"_lo_{sfx}"), threshold)
            # written once: the grid's counts and the join read it
            keys = keys.withColumn("_elements", pruning.elements(F.col(f"sorted_{sfx}")))
            keys = cut_lineage(keys.withColumn(f"_index_{sfx}", index).drop("_elements"), f"index-{sfx}")
            sides[sfx] = keys.withColumn("_element", F.explode(f"_index_{sfx}"))
        left, right, on = _salt_grid(sides["s1"], sides["s2"], ["block", "_element"], pairs_per_task)
        formed = F.col("_element") == F.array_min(F.array_intersect("_index_s1", "_index_s2"))
    elif most <= whole_block_pairs:
        left, right, on = sides["s1"], sides["s2"], ["block"]
    else:
        band = lambda c: F.floor(F.col(c) / int(length_band)).cast("int")
        left = sides["s1"].withColumn("_band", F.explode(F.sequence(band("_lo_s1"), band("_hi_s1"))))
        right, on = sides["s2"].withColumn("_band", band("len_s2")), ["block", "_band"]
    meets = (F.col("len_s2").between(F.col("_lo_s1"), F.col("_hi_s1")) & formed
             & pruning.can_reach("_sig_s1", "_sig_s2", F.col("len_s1"), F.col("len_s2"), threshold))
    # inside coalesce, so that the optimizer doesn't infer null checks that compute the signatures again below the join
    pairs = left.join(right, on).filter(F.coalesce(meets, F.lit(False)))
    return pairs.select("block", "clean_name_s1", "sorted_s1", "len_s1", "clean_name_s2", "sorted_s2", "len_s2")


def pruning_statistics(unlinked1: DataFrame, unlinked2: DataFrame, threshold: float, block_chars: int = 6,
                       lcs_engine: str | None = None) -> DataFrame:
    """Per block that both sides have: names, pairs of the block, pairs that are scored, pairs that reach the threshold."""
    count = lambda df, sfx: df.groupBy(block_key(f"clean_name_{sfx}", block_chars).alias("block")).agg(F.count("*").alias(f"names_{sfx}"))
    scored = score_pairs(pruned_pairs(unlinked1, unlinked2, threshold, block_chars, lcs_engine=lcs_engine), lcs_engine or DEFAULT_LCS_ENGINE)
    per = scored.groupBy("block").agg(F.count("*").alias("pairs_scored"), F.count_if(F.col("name_score") >= F.lit(float(threshold))).alias("pairs_passing"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    return (count(unlinked1, "s1").join(count(unlinked2, "s2"), "block").join(per, "block", "left").na.fill(0, ["pairs_scored", "pairs_passing"])
            .select("block", "names_s1", "names_s2", (whole("names_s1") * whole("names_s2")).cast("decimal(38,0)").alias("pairs_in_block"), "pairs_scored", "pairs_passing"))


DEFAULT_LCS_ENGINE = "arrow"


def score_pairs(pairs: DataFrame, lcs_engine: str = DEFAULT_LCS_ENGINE) -> DataFrame:
    """Adds ``name_score`` (token-sort ratio).  ``lcs_engine``: 'arrow' (vectorised batches,
    default) or 'jvm' (higher-order expressions); both give the same LCS."""
    if lcs_engine == "arrow":
        lcs = lcs_length_arrow("sorted_s1", "sorted_s2")
    elif lcs_engine == "jvm":
        lcs = F.expr(f"CASE WHEN len_s1 <= len_s2 THEN {lcs_sql('sorted_s1', 'sorted_s2', 'len_s1')} "
                     f"ELSE {lcs_sql('sorted_s2', 'sorted_s1', 'len_s2')} END")
    else:
        raise ValueError(f"unknown lcs engine {lcs_engine!r}")
    return pairs.withColumn("name_score", token_sort_ratio_from_lcs(lcs, "len_s1", "len_s2"))


def best_partners(scored: DataFrame, threshold: float) -> DataFrame:
    """Best list-2 name per list-1 name among pairs scoring >= threshold: highest score, ties
    to the smaller list-2 name.  The threshold sits inside the aggregate (min ignores the
    NULLs of failing pairs) rather than in a filter: a filter would be pushed below the
    score projection and the score computed twice."""
    passing = F.when(F.col("name_score") >= F.lit(float(threshold)),
                     F.struct((-F.col("name_score")).alias("neg"), F.col("clean_name_s2")))
    return (scored.groupBy("clean_name_s1").agg(F.min(passing).alias("b"))
            .filter(F.col("b").isNotNull())
            .select("clean_name_s1", "b.clean_name_s2", (-F.col("b.neg")).alias("name_score")))


def fuzzy_links(unlinked1: DataFrame, unlinked2: DataFrame, threshold: float,
                block_chars: int = 6, pairs_per_task: int | None = DEFAULT_PAIRS_PER_TASK,
                lcs_engine: str = DEFAULT_LCS_ENGINE) -> DataFrame:
    best = best_partners(score_pairs(pruned_pairs(unlinked1, unlinked2, threshold, block_chars,
                                                  pairs_per_task, lcs_engine=lcs_engine), lcs_engine), threshold)
    return (best.join(unlinked1, "clean_name_s1").join(unlinked2, "clean_name_s2")
            .withColumns({"match_type": F.lit("fuzzy_name"),
                          "match_confidence": F.col("name_score")}))


# --------------------------------------------------------------------------- assemble

def _entity(df: DataFrame, kind: str, confidence: Column | None = None) -> DataFrame:
    cols = {c: F.lit(None) for c in ENTITY_COLUMNS if c not in df.columns}
    df = df.withColumns(cols) if cols else df
    if kind in ("exact_name", "fuzzy_name"):
        cid = F.sha2(F.coalesce(F.col("clean_name_s1"), F.col("clean_name_s2")), 256)
    elif kind == "source1_only":
        cid = F.when(F.col("clean_name_s1") == "", F.col("row_id_s1")).otherwise(F.sha2(F.col("clean_name_s1"), 256))
    else:
        cid = F.when(F.col("clean_name_s2") == "", F.col("row_id_s2")).otherwise(F.sha2(F.col("clean_name_s2"), 256))
    canonical = {"source1_only": F.col("corporate_name_s1"), "source2_only": F.col("corporate_name_s2")}.get(
        kind, F.coalesce(F.col("corporate_name_s1"), F.col("corporate_name_s2")))
    df = df.withColumns({"corporate_id": cid, "canonical_name": canonical, "match_type": F.lit(kind)})
    if confidence is not None:
        df = df.withColumn("match_confidence", confidence)
    return df.select(*[F.col(c) for c in ENTITY_COLUMNS])


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def resolve_entities(source1: DataFrame, source2: DataFrame, threshold: float = 85.0,
                     block_chars: int = 6, materialize: bool = True, match_blank: bool = False,
                     one_to_one: bool = False, pairs_per_task: int | None = DEFAULT_PAIRS_PER_TASK,
                     lcs_engine: str = DEFAULT_LCS_ENGINE) -> DataFrame:
    """One row per entity with its link kind, confidence and representative columns.

    materialize     write the joined names and the best-partner table once (each feeds
                    several branches of the union) into the shared checkpoint folder
    match_blank     names that clean to '' link to each other (one exact entity) instead
                    of staying separate one-sided entities
    one_to_one      a list-2 name serves at most one fuzzy entity: the stable matching of all passing pairs
    pairs_per_task  split fuzzy blocks holding more pairs than this into cells (see
                    ``candidate_pairs``); None turns it off
    lcs_engine      'arrow' (vectorised batches) or 'jvm' (higher-order expressions)
    """
    g1 = collapse_side(prepare_source1(source1, block_chars), "s1", match_blank)
    g2 = collapse_side(prepare_source2(source2, block_chars), "s2", match_blank)
    return resolve_from_groups(g1, g2, threshold, block_chars, materialize, match_blank, one_to_one, pairs_per_task, lcs_engine)


def joined_names(g1: DataFrame, g2: DataFrame, match_blank: bool = False) -> DataFrame:
    """Both collapsed sides in one full outer join on the clean name: a row for every name of
    either side.  Blank names meet nothing, unless ``match_blank``."""
    key = lambda c: F.col(c) if match_blank else F.when(F.col(c) != "", F.col(c))
    return g1.join(g2, key("clean_name_s1") == key("clean_name_s2"), "full_outer")


def resolve_from_groups(g1: DataFrame, g2: DataFrame, threshold: float = 85.0, block_chars: int = 6,
                        materialize: bool = False, match_blank: bool = False, one_to_one: bool = False,
                        pairs_per_task: int | None = DEFAULT_PAIRS_PER_TASK,
                        lcs_engine: str = DEFAULT_LCS_ENGINE) -> DataFrame:
    """Same as ``resolve_entities`` from already collapsed sides: one join and one written table
    give exact links and what either side has left; the best partners are written once."""
    both = joined_names(g1, g2, match_blank)
    if materialize:
        both = cut_lineage(both, "names")
    in1, in2 = F.col("row_id_s1").isNotNull(), F.col("row_id_s2").isNotNull()
    exact = both.filter(in1 & in2).withColumns({"match_type": F.lit("exact_name"), "match_confidence": F.lit(100.0),
                                                "name_score": F.lit(None).cast("double")})
    u1, u2 = both.filter(in1 & ~in2).select(*g1.columns), both.filter(in2 & ~in1).select(*g2.columns)
    scored = score_pairs(pruned_pairs(named(u1, "s1"), named(u2, "s2"), threshold, block_chars, pairs_per_task, lcs_engine=lcs_engine), lcs_engine)
    best = stable_partners(scored, threshold) if one_to_one else best_partners(scored, threshold)
    if materialize:
        best = cut_lineage(best, "best")
    with_best = u1.join(best.withColumnRenamed("clean_name_s2", "_partner"), "clean_name_s1", "left")
    fuzzy = (with_best.filter(F.col("_partner").isNotNull()).join(u2, F.col("_partner") == F.col("clean_name_s2")).drop("_partner")
             .withColumns({"match_type": F.lit("fuzzy_name"), "match_confidence": F.col("name_score")}))
    only1 = with_best.filter(F.col("_partner").isNull()).drop("_partner", "name_score")
    only2 = u2.join(best.select("clean_name_s2").distinct(), "clean_name_s2", "left_anti")
    parts = [_entity(exact, "exact_name"), _entity(fuzzy, "fuzzy_name"),
             _entity(only1, "source1_only", F.lit(0.0)), _entity(only2, "source2_only", F.lit(0.0))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(_typed(p, parts[0]))
    return out


# --------------------------------------------------------------------------- rows

MAX_HOT_KEYS = 10_000
DEFAULT_ROWS_PER_TASK = 4_000_000


def _salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, count: str, row_id: str, r: int) -> DataFrame:
    """rows JOIN lookup ON key, with hot keys split across tasks.

    ``lookup`` carries, per key, how many input rows hold it (``count``).  A key is hot above
    ``r`` rows; with r >= total / MAX_HOT_KEYS at most MAX_HOT_KEYS keys are hot, so their
    (key, salts) table is small by construction and broadcast.  Rows of a hot key pick one of
    ceil(count / r) salts by hashing their row id; the lookup side is copied once per salt for
    hot keys only; one sort-merge join on (key, salt) then gives no reducer more than about
    r rows of one key."""
    salts = F.greatest(F.ceil(F.col(count) / F.lit(r)), F.lit(1)).cast("int")
    hot = lookup.filter(F.col(count) > F.lit(r)).select(key, salts.alias("_k")).distinct()
    salted_rows = (rows.join(F.broadcast(hot), key, "left")
                   .withColumn("_salt", F.pmod(F.xxhash64(row_id), F.coalesce(F.col("_k"), F.lit(1))).cast("int"))
                   .drop("_k"))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted_rows.join(salted_lookup.drop(count), [key, "_salt"]).drop("_salt")


def link_rows(source1: DataFrame, source2: DataFrame, entities: DataFrame, block_chars: int = 6,
              match_blank: bool = False, rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """Every input row with the entity it belongs to: (source, row_id, corporate_id, match_type) and its own columns.

    Rows join their entity on the clean name (blank names on the content id).  Names held
    by very many rows are salted (``_salted_lookup``), so a name carried by a third of all
    rows is spread over many tasks.  A list-2 name taken by several fuzzy entities maps its
    rows to each of them."""
    # the thin entity lookup is read by eight branches below: write it once
    entities = cut_lineage(entities.select("clean_name_s1", "clean_name_s2", "row_id_s1", "row_id_s2",
                                           "n_rows_s1", "n_rows_s2", "corporate_id", "match_type"), "lookup")
    # one number to the driver: an upper bound of the input rows behind the entities (a list-2
    # name shared by several fuzzy entities counts more than once, which only raises r)
    sums = entities.agg(F.sum("n_rows_s1").alias("a"), F.sum("n_rows_s2").alias("b")).first()
    total = (sums["a"] or 0) + (sums["b"] or 0)
    r = max(int(rows_per_task), -(-int(total) // MAX_HOT_KEYS))
    out = None
    for sfx, src, prepared in (("s1", "source1", prepare_source1(source1, block_chars)),
                               ("s2", "source2", prepare_source2(source2, block_chars))):
        clean, row_id, n_rows = f"clean_name_{sfx}", f"row_id_{sfx}", f"n_rows_{sfx}"
        own = S1_RAW if sfx == "s1" else S2_RAW
        rows = prepared.select(row_id, clean, *own)
        ids = entities.filter(F.col(clean).isNotNull()).select(clean, row_id, n_rows, "corporate_id", "match_type")
        by_name = F.lit(True) if match_blank else F.col(clean) != ""
        parts = [_salted_lookup(rows.filter(by_name), ids.filter(by_name).drop(row_id), clean, n_rows, row_id, r)]
        if not match_blank:
            parts.append(_salted_lookup(rows.filter(F.col(clean) == "").drop(clean),
                                        ids.filter(F.col(clean) == "").drop(clean), row_id, n_rows, row_id, r))
        for part in parts:
            part = part.select(F.lit(src).alias("source"), F.col(row_id).alias("row_id"), "corporate_id", "match_type", *own)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def block_statistics(source1: DataFrame, source2: DataFrame, block_chars: int = 6) -> DataFrame:
    """Per block: distinct names on each side and the name pairs blocking would compare."""
    n1 = (prepare_source1(source1, block_chars).filter(F.col("clean_name_s1") != "")
          .groupBy(F.col("name_block_s1").alias("block"))
          .agg(F.countDistinct("clean_name_s1").alias("names_s1"), F.count(F.lit(1)).alias("rows_s1")))
    n2 = (prepare_source2(source2, block_chars).filter(F.col("clean_name_s2") != "")
          .groupBy(F.col("name_block_s2").alias("block"))
          .agg(F.countDistinct("clean_name_s2").alias("names_s2"), F.count(F.lit(1)).alias("rows_s2")))
    return (n1.join(n2, "block", "full_outer")
            .na.fill(0, ["names_s1", "rows_s1", "names_s2", "rows_s2"])
            .withColumn("candidate_pairs", (F.col("names_s1").cast("decimal(19,0)") * F.col("names_s2").cast("decimal(19,0)")).cast("decimal(38,0)")))
