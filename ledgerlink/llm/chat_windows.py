"""Chat formatting in budgeted windows.

Native: everything here is a DataFrame or SQL expression.

Each conversation is cut into windows of whole turns.  With S the prefix sum of the turns' tokens and T the tokens that a
window has for new turns (the budget less the system turn and the history), a turn whose tokens lie in one stretch
[kT, (k+1)T) of S belongs to window (k, k); one that crosses a stretch's end is a window by itself.  So a window holds T tokens of new
turns at most, or one turn that is longer, and no window depends on where the one before ended.
Each window shows the leading system turn, then as many turns before it as fit into ``HISTORY`` tokens (whole turns only), then its new turns.
Text repeated from before is marked as context and never under the loss mask; each assistant text is under it once.

Prefix sums run over blocks of ``BLOCK`` turn numbers, whose totals are aggregated and summed first: a conversation of very
many turns is spread over many tasks, and a window that is collected is bounded by its budget.

A turn is written as mark, role, newline, text, end mark.  Marks and other templates' control strings inside roles and texts are escaped
(``~0`` to ``~6``), so the marks split the output exactly and ``unescape`` gives the text back.

Defined results.  Null role or text: empty.  Null conversation id: a conversation of its own.  Turns are ordered by turn number (null first), role, text; ties and
repeated rows are turns of their own.  A system turn counts as leading only if it is the first.  An empty text is an empty turn.  A longer turn than
the budget stays whole and is flagged.  Empty table: no windows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlink.llm.frames import stage

BUDGET, HISTORY, LEAST_NEW = 512, 128, 64
TURN_TOKENS, CHARS_A_TOKEN = 4, 4
BLOCK = 1024

# The template's marks, and the strings that are escaped (in this order; ``~`` first).
TURN, CONTEXT, END = "<|turn|>", "<|context|>", "<|end|>\n"
ESCAPES = [("~", "~0"), ("<|", "~1"), ("</s>", "~2"), ("[INST]", "~3"), ("[/INST]", "~4"), ("<s>", "~5")]
NEWLINE = ("\n", "~6")  # in roles only


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in [NEWLINE, *reversed(ESCAPES)]:
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def estimated_tokens(text: Column) -> Column:
    """Tokens of a turn, marks included."""
    return F.floor((F.length(text) + CHARS_A_TOKEN - 1) / CHARS_A_TOKEN).cast("long") + TURN_TOKENS


def _turns(rows: DataFrame, tokens) -> DataFrame:  # noqa: ANN001
    """(conv, role, text, tokens, upto, leads): upto is the prefix sum, leads whether it is the leading system turn."""
    r = rows.withColumn("tokens", tokens(F.col("text"))).withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK).cast("long"))
    before = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (r.groupBy("conv", "block").agg(F.sum("tokens").alias("n"))
              .select(F.col("conv").alias("of_conv"), F.col("block").alias("of_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off")))
    placed = r.join(blocks, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block")))
    inside = W.partitionBy("conv", "block").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    return (placed.withColumn("upto", F.col("off") + F.sum("tokens").over(inside))
            .withColumn("leads", (F.col("upto") == F.col("tokens")) & (F.col("role") == "system"))
            .select("conv", "role", "text", "tokens", "upto", "leads"))


def chat_windows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 budget: int = BUDGET, history: int = HISTORY, tokens=estimated_tokens) -> DataFrame:  # noqa: ANN001
    """One row per window: conv, window (in order), formatted, loss (array of start, end in code points), n_tokens, over_budget."""
    turns = rows.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    turns = stage(_turns(turns, tokens), "turns")
    lead = turns.filter("leads").select(F.col("conv").alias("of"), F.col("role").alias("lead_role"), F.col("text").alias("lead_text"), F.col("tokens").alias("lead_tokens"))
    new = F.greatest(F.lit(budget - history) - F.coalesce("lead_tokens", F.lit(0)), F.lit(LEAST_NEW))
    placed = (turns.join(lead.select("of", "lead_tokens"), F.col("conv").eqNullSafe(F.col("of")), "left")
              .withColumn("size", new)
              .withColumn("stop", F.col("upto") - F.coalesce("lead_tokens", F.lit(0))).withColumn("start", F.col("stop") - F.col("tokens")).drop("of", "lead_tokens"))
    body = placed.filter("not leads")
    first_part, last_part = F.expr("start div size"), F.expr("(stop - 1) div size")
    body = body.withColumn("window", 2 * first_part + (last_part > first_part).cast("long"))
    windows = body.groupBy("conv", "window").agg(F.min("start").alias("at")).select(F.col("conv").alias("of"), F.col("window").alias("w"), "at")
    entry = ["conv", "window", "kind", "start", "role", "text", "tokens"]
    # kinds: 0 leading system turn, 1 system turn again, 2 history, 3 new turn
    fresh = body.withColumn("kind", F.lit(3)).select(*entry)
    # the windows that may begin between a turn's end and HISTORY tokens after its start
    reach = F.expr(f"sequence(2 * (stop div size), greatest(2 * (stop div size), 2 * ((start + {history}) div size) + 1))")
    past = (body.withColumn("w_try", F.explode(reach)).join(windows, F.col("conv").eqNullSafe(F.col("of")) & (F.col("w_try") == F.col("w")))
            .filter((F.col("at") >= F.col("stop")) & (F.col("at") - F.col("start") <= history) & (F.col("w") > F.col("window")))
            .withColumn("window", F.col("w")).withColumn("kind", F.lit(2)).select(*entry))
    # the first window starts at 0, in stretch 0; a conversation of a system turn alone has that window too
    again = (windows.withColumnsRenamed({"of": "conv"}).filter("at > 0").join(lead, F.col("conv").eqNullSafe(F.col("of")))
             .select("conv", F.col("w").alias("window"), F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("start"),
                     F.col("lead_role").alias("role"), F.col("lead_text").alias("text"), F.col("lead_tokens").alias("tokens")))
    begin = windows.filter("at = 0").select("of", F.col("w").alias("window"))
    opening = (lead.withColumnRenamed("of", "conv").join(begin, F.col("conv").eqNullSafe(F.col("of")), "left")
               .select("conv", F.coalesce("window", F.lit(0).cast("long")).alias("window"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("start"),
                       F.col("lead_role").alias("role"), F.col("lead_text").alias("text"), F.col("lead_tokens").alias("tokens")))
    entries = fresh.unionByName(past).unionByName(again).unionByName(opening)
    mark = F.when(F.col("kind").isin(0, 3), F.lit(TURN)).otherwise(F.lit(CONTEXT))
    head = F.concat(mark, F.replace(escape(F.col("role")), F.lit(NEWLINE[0]), F.lit(NEWLINE[1])), F.lit("\n"))
    entries = entries.withColumn("head", head).withColumn("body", escape(F.col("text"))).withColumn("piece", F.concat("head", "body", F.lit(END)))
    by = W.partitionBy("conv", "window").orderBy("start")
    upto = F.sum(F.length("piece")).over(by.rowsBetween(W.unboundedPreceding, 0))
    entries = entries.withColumn("from", upto - F.length("piece") + F.length("head"))
    span = F.when((F.col("kind") == 3) & (F.col("role") == "assistant"), F.struct(F.col("from").alias("start"), (F.col("from") + F.length("body")).alias("end")))
    out = entries.withColumn("span", span).groupBy("conv", "window").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"), F.sort_array(F.collect_list("span")).alias("loss"), F.sum("tokens").alias("n_tokens"))
    return out.select("conv", "window", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss", "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"))


def read_back(windows: DataFrame) -> DataFrame:
    """(conv, window, turns, loss_texts): the turns that each window adds and the texts under its mask, out of its formatted text alone."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n", -1), lambda p: p.startswith(TURN))
    bare = F.transform(pieces, lambda p: F.substring(p, F.lit(len(TURN) + 1), F.length(p)))
    turns = F.transform(bare, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text")))
    texts = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return windows.select("conv", "window", turns.alias("turns"), texts.alias("loss_texts"), "formatted", "n_tokens", "over_budget")
