"""One-to-one links: the stable matching of scored name pairs, as rounds of joins and aggregates.

Both sides rank their partners by score; ties go to the smaller name.  These rankings agree with one order of all pairs
(score, then names), so exactly one matching is stable: no two names would both rather have each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.sources.store import stage

S1, S2, SCORE = "clean_name_s1", "clean_name_s2", "name_score"


def stable_partners(scored: DataFrame, threshold: float) -> DataFrame:
    """(clean_name_s1, clean_name_s2, name_score) of the stable matching among pairs that reach the threshold.

    In each round every name proposes to its best remaining partner; pairs that propose to each other are matched for good, and all other
    pairs of the matched names go.  The best remaining pair of all is always among them, so rounds end; a round's
    pairs are written once and shrink.  The longest chain of names that each wait for a better-placed rival bounds the rounds.
    A name's proposals are one partial aggregate, so a name wanted by a third of the other side costs a task one row."""
    left = stage(scored.select(S1, S2, SCORE), "scored").filter(F.col(SCORE) >= F.lit(float(threshold)))
    matched = None
    while True:
        mine = left.groupBy(S1).agg(F.min(F.struct((-F.col(SCORE)).alias("n"), F.col(S2))).alias("b")).select(S1, F.col(f"b.{S2}").alias(S2), (-F.col("b.n")).alias(SCORE))
        theirs = left.groupBy(S2).agg(F.min(F.struct((-F.col(SCORE)).alias("n"), F.col(S1))).alias("b")).select(F.col(f"b.{S1}").alias(S1), S2)
        mutual = stage(mine.join(theirs, [S1, S2]), "matched")
        if mutual.isEmpty():
            return mutual if matched is None else matched
        matched = mutual if matched is None else matched.unionByName(mutual)
        left = stage(left.join(mutual.select(S1), S1, "left_anti").join(mutual.select(S2), S2, "left_anti"), "proposals")
