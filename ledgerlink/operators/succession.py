"""What became of registry keys between two batches.

A key is made from a list-1 name where there is one, so it can vanish although its company lives on: a list-2-only entity that is now linked
goes by its partner's key.  Names connect the two batches: an old entity and a new one belong together if they
hold the same name of the same list (blank names: the same row).  The connected components over (old key, name, new key) say whether
keys were renamed, merged or split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.sources.store import stage

KEY = "corporate_id"


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label): the least node reachable from each node of ``links`` (a, b).

    Every round each node takes the least label among its neighbours' (a partial aggregate, so a node with very many links costs a task one
    row for each of its neighbours it reads), then the label of that label; distances shrink by half or more.  Labels are written once a round;
    the driver gets the number of changes."""
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        now = stage(nearer.join(further, "label", "left").select("node", "before", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        labels = now.select("node", "label")
        if now.filter("label <> before").isEmpty():
            return labels


def _names(entities: DataFrame) -> DataFrame:
    """(corporate_id, name): the names an entity holds, told apart by list; the row id stands in for a blank name."""
    own = [F.when(F.col(f"clean_name_{s}") != "", F.concat(F.lit(f"{s}:"), f"clean_name_{s}")).when(
        F.col(f"clean_name_{s}") == "", F.concat(F.lit(f"{s}#"), f"row_id_{s}")) for s in ("s1", "s2")]
    return entities.select(KEY, F.explode(F.filter(F.array(*own), lambda x: x.isNotNull())).alias("name"))


def _open_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """(tag, corporate_id, name) of the names of both batches whose component isn't known from one look at their holders.

    A name is plain if each batch has one holder of it at most, of the same key.  A key with plain names alone shares them with nobody but
    itself in the other batch, so its component is complete: most keys of a registry don't change, and never meet another one here."""
    both = before.select(F.lit("old").alias("tag"), KEY, "name").unionByName(after.select(F.lit("new").alias("tag"), KEY, "name")).filter(F.col(KEY).isNotNull())
    holders = both.groupBy("name").agg(F.count_if(F.col("tag") == "old").alias("o"), F.count_if(F.col("tag") == "new").alias("n"), F.min(KEY).alias("x"), F.max(KEY).alias("y"))
    shared = holders.filter("o > 1 or n > 1 or x <> y").select("name")
    keys = stage(both.join(shared, "name", "left_semi").select(KEY).distinct(), "open-keys")
    return stage(both.join(keys, KEY, "left_semi").select("tag", KEY, "name"), "open-names")


def entity_succession(old: DataFrame, new: DataFrame) -> DataFrame:
    """A row for each key of ``old`` that ``new`` doesn't have: stale_id, successor_id, n_successors, kind, n_old, n_new.

    ``old``, ``new``: entities (``resolve_entities``).  successor_id: the least new key among those that hold one of the old
    entity's names (NULL if there is none), n_successors their number; n_old and n_new: the keys of its component.
    kind: renamed (one key became another), merged (several became one), split (one became several), regrouped (several
    became several), gone (none of its names is left)."""
    before, after = stage(_names(old), "old-names"), stage(_names(new), "new-names")
    links = _open_rows(before, after).select(F.concat_ws(":", "tag", KEY).alias("a"), F.concat(F.lit("name:"), "name").alias("b"))
    labels = stage(component_labels(links), "components")
    sizes = labels.groupBy("label").agg(F.count_if(F.col("node").startswith("old:")).alias("n_old"), F.count_if(F.col("node").startswith("new:")).alias("n_new"))
    stale = before.join(after.select(KEY).distinct(), KEY, "left_anti")
    # one row for each name, so that names held by very many entities aren't paired entity by entity
    holders = after.groupBy("name").agg(F.min(KEY).alias("least"), F.count("*").alias("n"))
    # an old entity holds two names at most: a new one with both counts once
    pairs = after.groupBy(KEY).agg(F.sort_array(F.collect_list("name")).alias("names")).filter(F.size("names") == 2).groupBy("names").agg(F.count("*").alias("both"))
    per = stale.join(holders, "name", "left").groupBy(KEY).agg(
        F.min("least").alias("successor_id"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n"), F.sort_array(F.collect_list("name")).alias("names"))
    per = per.join(pairs, "names", "left").withColumn("n_successors", F.col("n") - F.coalesce("both", F.lit(0).cast("long")))
    # a key without open names is alone in its component, and gone: were it there anew, it wouldn't be stale
    out = per.filter(F.col(KEY).isNotNull()).join(labels, F.concat(F.lit("old:"), KEY) == F.col("node"), "left").join(sizes, "label", "left").na.fill({"n_old": 1, "n_new": 0})
    kind = (F.when(F.col("n_new") == 0, "gone").when((F.col("n_old") == 1) & (F.col("n_new") == 1), "renamed").when(F.col("n_new") == 1, "merged")
            .when(F.col("n_old") == 1, "split").otherwise("regrouped"))
    return out.select(F.col(KEY).alias("stale_id"), "successor_id", "n_successors", kind.alias("kind"), "n_old", "n_new")
