"""Quality rules: fixed base rules, then adaptive thresholds from mergeable quantile sketches.

Native: everything here is a DataFrame or SQL expression.

1. ``with_metrics`` derives counts of each whole text in one struct column.
2. ``quantile_sketch`` counts texts per (group, metric, bucket).  A bucket keeps the seven leading
   bits of the value (relative error below 1/64), so a sketch is a set of counts: two sketches merge
   by adding counts, in any order, with the same result.  Rows pre-aggregate before the shuffle, so a
   group that holds a third of all rows leaves each task as a few hundred counts.
3. ``thresholds`` reads quartiles off the sketch and puts an upper fence at
   ``q75 + spreads * max(q75 - q25, least spread)``, per (language, source).  A group with fewer than
   ``support`` texts takes the fence of its language, a language with fewer the fence of all texts.
   A group is measured against the other groups, each with equal weight: the limit is ``loosest`` times the
   median fence of its siblings, of which it is no part, so a source of any size can't acquit itself while
   less than half of its siblings are junk.  A group whose quartiles lie within the least spread has a level of
   its own and ``loosest`` times that limit.  A group without siblings is measured against those of its parent; one
   that is alone in the corpus has nothing to be measured against.
4. ``judge`` joins the fences to the rows and decides.

Defined results.  Null or empty text: no words, so the base rules fail it.  Null language or source:
a group of its own.  Repeated rows: each is counted and judged, equal rows equally.  Empty table: no
rows.  Extra columns are kept and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlink.llm.frames import fresh, stage

SPACE = "\x20\t\n\x0b\x0c\r"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Adaptive metrics: name -> least spread, in the metric's unit (thousandths).
METRICS = {"symbols": 15, "dup_lines": 150, "repeats": 120, "capitals": 60, "exclaims": 60}
SPREADS = 3
SUPPORT = 100
LOOSEST = 2
LEADING_BITS = 7


def metrics_of(text: Column) -> Column:
    """Struct of whole-text counts; null text counts as empty."""
    t = F.coalesce(text, F.lit(""))
    # split() on runs of white space leaves at most one empty string at either end
    words = F.filter(F.split(t, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda s: F.rtrim(s, F.lit(SPACE)) != "")
    n = F.size(words)
    return F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated_words(words).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit("\\p{Lu}")).cast("long").alias("n_capitals"),
        (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long").alias("n_exclaims"),
    )


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    The windows (three words and their place) are sorted inside the row, so equal windows are
    neighbours; each neighbouring pair marks the six places it covers.  n log n for any length."""
    n = F.size(words)
    windows = F.sort_array(F.arrays_zip(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))).alias("a"),
        F.slice(words, 2, F.greatest(n - 2, F.lit(0))).alias("b"),
        F.slice(words, 3, F.greatest(n - 2, F.lit(0))).alias("c"),
        F.when(n > 2, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>")).alias("at")))
    # bound once by the one-element array, so the sort isn't repeated for each use
    places = F.transform(F.array(windows), lambda w: F.transform(
        F.filter(F.arrays_zip(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))).alias("x"),
                              F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))).alias("y")),
                 lambda p: (p["x"]["a"] == p["y"]["a"]) & (p["x"]["b"] == p["y"]["b"]) & (p["x"]["c"] == p["y"]["c"])),
        lambda p: F.array(p["x"]["at"], p["x"]["at"] + 1, p["x"]["at"] + 2,
                          p["y"]["at"], p["y"]["at"] + 1, p["y"]["at"] + 2)))
    return F.when(n > 3, F.size(F.array_distinct(F.flatten(F.flatten(places))))).otherwise(0)


def _share(part: Column, whole: Column) -> Column:
    """Thousandths, rounded down; 0 of 0 is 0."""
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("long")


def _values(m: Column) -> dict[str, Column]:
    return {
        "symbols": _share(m["n_symbols"], m["word_chars"]),
        "dup_lines": _share(m["n_dup_lines"], m["n_lines"]),
        "repeats": _share(m["n_repeat_words"], m["n_words"]),
        "capitals": _share(m["n_capitals"], m["word_chars"]),
        "exclaims": _share(m["n_exclaims"], m["n_words"]),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def with_metrics(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    return docs.withColumn(name, metrics_of(F.col(f"`{text_col}`")))


def quantile_sketch(docs: DataFrame, metrics: str, groups: list[str]) -> DataFrame:
    """Counts per (group columns g0.., metric, bucket) over all texts that pass the base rules."""
    m = F.col(f"`{metrics}`")
    rows = docs.filter(~base_failed(m)).select(
        *[F.col(f"`{g}`").cast("string").alias(f"g{i}") for i, g in enumerate(groups)],
        F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in _values(m).items()])).alias("v"))
    value = F.col("v.value")
    drop = F.greatest(F.length(F.bin(value)) - LEADING_BITS, F.lit(0))
    bucket = F.expr("shiftleft(shiftright(value, cut), cut)")
    return (rows.select(*[f"g{i}" for i in range(len(groups))], F.col("v.metric").alias("metric"), value.alias("value"), drop.alias("cut"))
            .withColumn("bucket", bucket)
            .groupBy(*[f"g{i}" for i in range(len(groups))], "metric", "bucket").agg(F.count("*").alias("n")))


def merge_sketches(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the sketches of all groups that share ``keys``."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, total, fence, tight) from the quartiles of each sketch; tight: they lie within the least spread."""
    by = [*keys, "metric"]
    ranked = (sketch.withColumn("upto", F.sum("n").over(W.partitionBy(*by).orderBy("bucket")))
              .withColumn("total", F.sum("n").over(W.partitionBy(*by))))
    quartile = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bucket")))
    least = F.create_map(*[x for k, v in METRICS.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    return (ranked.groupBy(*by).agg(F.max("total").alias("total"), quartile(1).alias("q25"), quartile(3).alias("q75"))
            .withColumn("fence", F.col("q75") + SPREADS * F.greatest(F.col("q75") - F.col("q25"), least[F.col("metric")]))
            .select(*by, "total", "fence", (F.col("q75") - F.col("q25") <= least[F.col("metric")]).alias("tight")))


def _same(keys: list[str]) -> Column:
    """Equal keys of the sides ``o`` and ``f``; nulls are equal."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"o.{k}").eqNullSafe(F.col(f"f.{k}"))
    return cond


def _by_metric(fences: DataFrame, every: list[str]) -> DataFrame:
    return fences.groupBy(*every).agg(*[F.max(F.when(F.col("metric") == k, F.col("best"))).alias(k) for k in METRICS])


def _medians(values: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, n, mid, low, high) of the groups' values, each group once.  ``mid`` is the lower median of all;
    the lower median without one group is ``high`` if that group's value is ``low`` or less, else ``low`` (null: no other).

    Values are counted first (a few thousand different ones at most), so it doesn't matter how many groups there are."""
    by = [*keys, "metric"]
    counts = values.groupBy(*by, "value").agg(F.count("*").alias("n"))
    ranked = (counts.withColumn("upto", F.sum("n").over(W.partitionBy(*by).orderBy("value")))
              .withColumn("total", F.sum("n").over(W.partitionBy(*by))))
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("value")))
    half = F.floor(F.col("total") / 2)
    return ranked.groupBy(*by).agg(F.max("total").alias("n"), at(F.ceil(F.col("total") / 2)).alias("mid"), at(F.greatest(half, F.lit(1))).alias("low"), at(half + 1).alias("high"))


def thresholds(sketch: DataFrame, n_groups: int) -> DataFrame:
    """One row per group: g0.., one fence column per metric (upper bound, inclusive), by references that no group moves by
    its size or by its own texts.

    Upwards, the value of a group of the finest level is its own fence, that of a wider group the median of the values
    of its supported parts (its own fence if it has none).  Downwards, a group's reference is the median value of its
    supported siblings, or its parent's reference if it has none."""
    levels = [[f"g{i}" for i in range(k)] for k in range(n_groups + 1)]
    every = levels[-1]
    values: list[DataFrame] = []
    for keys in reversed(levels):
        own = _fences(merge_sketches(sketch, keys), keys).withColumn("value", F.col("fence"))
        if values:
            parts = _medians(values[0].filter(F.col("total") >= SUPPORT), keys).select(*keys, "metric", "mid")
            own = (own.alias("o").join(parts.alias("f"), _same([*keys, "metric"]), "left")
                   .select("o.*", "f.mid").withColumn("value", F.coalesce("mid", "value")).drop("mid"))
        values.insert(0, stage(own.select(*keys, "metric", "total", "value", "tight"), "values"))
    top = values[0].select("metric", F.col("value").alias("best"), F.lit(None).cast("long").alias("reference"))
    out = sketch.select(*every, "metric").distinct().join(top, "metric")
    for above, keys, own in zip(levels, levels[1:], values[1:], strict=False):
        mid = _medians(own.filter(F.col("total") >= SUPPORT), above)
        f = own.alias("o").join(mid.alias("f"), _same([*above, "metric"]), "left").select(
            "o.*", F.when(F.col("o.total") < SUPPORT, F.col("f.mid")).when(F.col("f.n") > 1, F.when(F.col("o.value") <= F.col("f.low"), F.col("f.high")).otherwise(F.col("f.low"))).alias("others"))
        reference = F.coalesce(F.col("f.others"), F.col("o.reference"))
        widest = F.when(F.col("f.tight"), LOOSEST * LOOSEST).otherwise(LOOSEST) * reference  # null (no bound) without a reference
        best = F.when(F.col("f.total") >= SUPPORT, F.least(F.col("f.value"), widest)).otherwise(F.col("o.best"))
        out = out.alias("o").join(f.alias("f"), _same([*keys, "metric"])).select(
            *[F.col(f"o.{g}").alias(g) for g in every], F.col("o.metric").alias("metric"), best.alias("best"), reference.alias("reference"))
    return _by_metric(out, every)


def judge(docs: DataFrame, metrics: str, fences: DataFrame, groups: list[str], kept: str) -> DataFrame:
    """``docs`` plus the boolean column ``kept``."""
    m = F.col(f"`{metrics}`")
    limits = fences.select(F.struct(*METRICS).alias("_f"), *[F.col(f"g{i}").alias(f"_g{i}") for i in range(len(groups))])
    name = fresh(docs, "_fences")
    limits = limits.withColumnRenamed("_f", name)
    keys = {f"_g{i}": fresh(docs, f"_key{i}") for i in range(len(groups))}
    for old, new in keys.items():
        limits = limits.withColumnRenamed(old, new)
    cond = F.lit(True)
    for (new, g) in zip(keys.values(), groups, strict=True):
        cond = cond & F.col(f"`{g}`").cast("string").eqNullSafe(limits[new])
    joined = docs.join(limits, cond, "left")
    f = joined[name]
    inside = F.lit(True)
    for k, v in _values(m).items():
        inside = inside & F.coalesce(v <= f[k], F.lit(True))
    return joined.withColumn(kept, ~base_failed(m) & inside).drop(name, *keys.values())


def quality_rules(docs: DataFrame, groups: list[str], text_col: str = "text", keep_columns: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """(rows with metrics and verdict, name of the metrics struct, name of the verdict).

    ``keep_columns`` names the input columns to carry (default: all)."""
    metrics, kept = fresh(docs, "_metrics"), fresh(docs, "_kept")
    carried = [F.col(f"`{c}`") for c in (keep_columns or docs.columns)]
    rows = stage(with_metrics(docs, metrics, text_col).select(*carried, metrics), "quality")
    fences = stage(thresholds(stage(quantile_sketch(rows, metrics, groups), "sketch"), len(groups)), "fences")
    return judge(rows, metrics, fences, groups, kept), metrics, kept


def quality_filter(docs: DataFrame, groups: list[str], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    rows, _, kept = quality_rules(docs, groups, text_col)
    return rows.filter(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
