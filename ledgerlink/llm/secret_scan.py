"""Secret scans: base patterns, then corpus-wide ownership frequency of what they find.

Native: everything here is a DataFrame or SQL expression.

1. ``candidates`` finds the matches of every kind in each whole text.  A match's place is the sum of the lengths
   of the gaps and matches before it (a running sum per text and kind).
2. ``ownership`` aggregates the hash of each value by the distinct owners and repositories that hold it.  Rows are
   reduced to distinct (hash, owner, repository) first, with partial aggregation, so a value that a third of all texts
   copy leaves each task as a few rows.
3. A value with ``EXAMPLE_OWNERS`` owners or more, or one that reads like a placeholder, is an example that was copied around;
   the others look live.
4. Two kinds of spans are added to the base ones, where they don't overlap one: ``reuse``, a token that is the value
   of a base match anywhere in the corpus; ``opaque``, a token with lower-case and upper-case letters and digits
   whose value has fewer than ``EXAMPLE_OWNERS`` owners.  Tokens are read twice for that: as runs of the characters of an assigned value, which may hold
   ``.`` and ``=``, and without those two.  From ``LEAST_VALUE`` characters any such token with a digit, or a capital after a small letter, is looked up
   (a plain word, though someone's password, isn't: its every use would be a span).  Values are compared without ``.``, ``=`` and ``-`` at their
   end, so a value that ends a sentence is the value.

Texts are identified by (id, hash of the text): rows equal in both share their spans, so an id may be
null or repeat; owners and repositories of all of them count.  Null or empty text has no spans.  A null owner or repository counts as one owner or repository.  Very long texts are scanned whole; ties
can't occur (a span is its kind, start and end).  Empty table: no rows.  Extra columns are kept and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlink.llm.frames import fresh, stage, text_hash

# Fixed patterns.  A run of one class that is long enough is found alike by a least length in the pattern; only the
# value of an assignment is measured afterwards, since a match that fails still takes up its text.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
TOKEN = "A-Za-z0-9+/_-"
#: Tokens from 12 characters that may be values, and those that may hold a full stop or equals sign.
OPAQUE = f"(?<![{TOKEN}])(?=[{TOKEN}]{{12}})(?=[{TOKEN}]*?(?:[0-9]|[a-z][A-Z]))[{TOKEN}]++"
WIDE = f"(?<![.={TOKEN}])(?=[.={TOKEN}]{{12}})(?=[{TOKEN}]*+[.=])(?=[.={TOKEN}]*?(?:[0-9]|[a-z][A-Z]))[.={TOKEN}]++"
AT_END = ".=-"

LEAST_VALUE = 12
LEAST_OPAQUE = 20
EXAMPLE_OWNERS = 5
PLACEHOLDER = "(?i)example|changeme|placeholder|your[_-]|xxxx|0123456789"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "reuse", "opaque")


def _matches(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """array<struct<kind, j, gap, len, value>>: gap is the length of the text between a match and the one before it."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    return F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("m"), value.alias("v")), lambda x, j: F.struct(
        F.lit(kind).alias("kind"), j.alias("j"), F.length(x["g"]).cast("long").alias("gap"), F.length(x["m"]).cast("long").alias("len"), x["v"].alias("value")))


def matches(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: list[str]) -> DataFrame:
    """(id, text_hash, owner, repo, kind, j, gap, len, value, value_hash): every match in every row, tokens included, in the order of each kind."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = F.concat(_matches(text, "assign", ASSIGN, 2), _matches(text, "access", ACCESS), _matches(text, "hex", HEX), _matches(text, "opaque", OPAQUE), _matches(text, "wide", WIDE))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_hash(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{owner_col}`").cast("string").alias("owner"),
        F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in repo_cols]).alias("repo"), F.explode(found).alias("f")).select("*", "f.*").drop("f")
    return rows.withColumn("value_hash", F.sha2(F.rtrim("value", F.lit(AT_END)), 256))


def _is_value() -> Column:
    return ~((F.col("kind") == "assign") & (F.length("value") < LEAST_VALUE))


def placed(found: DataFrame) -> DataFrame:
    """(id, text_hash, kind, start, end, value, value_hash) of all matches of ``matches``, once for rows equal in id and text."""
    by = W.partitionBy("id", "text_hash", "kind").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    once = found.select("id", "text_hash", "kind", "j", "gap", "len", "value", "value_hash").distinct()
    end = F.sum(F.col("gap") + F.col("len")).over(by)
    return once.select("id", "text_hash", "kind", (end - F.col("len")).alias("start"), end.alias("end"), "value", "value_hash").filter(_is_value())


def ownership(found: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repos, in_base): in how many owners and repositories a value is held, and whether a base match holds it."""
    pairs = (found.filter(_is_value()).select("value_hash", F.col("kind").isin(*BASE).alias("base"), "owner", "repo")
             .groupBy("value_hash", "owner", "repo").agg(F.max("base").alias("base")))
    owners = pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"), F.max("base").alias("base"))
    return owners.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("base").alias("in_base"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: list[str] | None = None) -> DataFrame:
    """One row per span: id, text_hash, kind, start, end (code points, end exclusive), value_length, n_owners, n_repos, live."""
    found = stage(matches(docs, id_col, text_col, owner_col, repo_cols or [owner_col]), "secrets")
    known = placed(found).join(ownership(found), "value_hash")
    few = F.col("n_owners") < EXAMPLE_OWNERS
    mixed = (F.length("value") >= LEAST_OPAQUE) & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[0-9]")
    # a token read both ways is one span: the wide one only where a full stop or equals sign stands inside
    bare = F.rtrim("value", F.lit(AT_END))
    reused = F.col("in_base") & (F.length(bare) >= LEAST_VALUE) & ((F.col("kind") == "opaque") | bare.rlike("[.=]"))
    kind = F.when(F.col("kind").isin(*BASE), F.col("kind")).when(reused, F.lit("reuse")).when((F.col("kind") == "opaque") & mixed & few & ~F.col("in_base"), F.lit("opaque"))
    named = known.withColumn("was", kind).filter(F.col("was").isNotNull())
    cut = F.when(F.col("was") == "reuse", bare).otherwise(F.col("value"))
    named = (named.withColumn("end", F.when(F.col("was") == "reuse", F.col("start") + F.length(bare)).otherwise(F.col("end"))).withColumn("value", cut)
             .withColumn("kind", F.col("was")).drop("was"))
    base = F.col("kind").isin(*BASE)
    doc = W.partitionBy("id", "text_hash")
    order = [F.col("start"), F.col("end"), F.col("kind")]
    before = F.max(F.when(base, F.col("end"))).over(doc.orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(doc.orderBy(*order).rowsBetween(1, W.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    live = few & ~F.col("value").rlike(PLACEHOLDER)
    return (named.withColumn("clear", clear).filter(base | F.col("clear"))
            .select("id", "text_hash", "kind", "start", "end", F.length("value").cast("long").alias("value_length"), "n_owners", "n_repos", live.alias("live")))


def kind_rank(kind: Column) -> Column:
    return F.array_position(F.lit(list(KINDS)), kind)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: list[str] | None = None, length_col: str | None = None) -> DataFrame:
    """``docs`` with the value of every span replaced by ``[SECRET]`` (``[EXAMPLE]`` where it was copied around).

    Overlapping values are replaced together.  ``length_col`` (if there) is set to the new length of changed texts."""
    spans = secret_spans(docs, id_col, text_col, owner_col, repo_cols)
    doc = W.partitionBy("id", "text_hash")
    s = spans.select("id", "text_hash", (F.col("end") - F.col("value_length")).alias("start"), "end", "live")
    reach = F.max("end").over(doc.orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    s = s.withColumn("new", F.when(F.coalesce(reach, F.lit(-1)) > F.col("start"), 0).otherwise(1)).withColumn("part", F.sum("new").over(doc.orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)))
    s = s.groupBy("id", "text_hash", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("live").alias("live"))
    s = s.withColumn("from", F.coalesce(F.lag("end").over(doc.orderBy("start")), F.lit(0)))
    cuts, bad_id, bad_hash = fresh(docs, "_cuts"), fresh(docs, "_bad_id"), fresh(docs, "_bad_hash")
    s = s.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("from", "start", "end", "live"))).alias(cuts)).withColumnsRenamed({"id": bad_id, "text_hash": bad_hash})
    text = F.col(f"`{text_col}`")
    joined = docs.join(s, docs[id_col].eqNullSafe(s[bad_id]) & (text_hash(docs[text_col]) == s[bad_hash]), "left")
    # ``substring`` counts code points from 1
    parts = F.transform(cuts, lambda c: F.concat(F.substring(text, c["from"] + 1, c["start"] - c["from"]), F.when(c["live"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]"))))
    rest = F.substring(text, F.element_at(cuts, -1)["end"] + 1, F.length(text))
    new = {text_col: F.when(F.col(cuts).isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))}
    out = joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns], cuts)
    if length_col and length_col in docs.columns:
        kept = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(cuts).isNull(), F.col(f"`{length_col}`")).otherwise(F.length(text).cast(kept)))
    return out.drop(cuts)
