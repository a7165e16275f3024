"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the mill by the river ground barley for three villages until the flood of that spring took its wheel away and no one built another"


def prose(seed: int, n: int = 80) -> str:
    words = PROSE.split()
    return " ".join(f"{words[(seed * 7 + i * (seed % 5 + 1)) % len(words)]}{(seed * 31 + i * i) % 97}" for i in range(n))


def rows():
    long = " ".join(prose(i, 200) for i in range(60))
    return [
        (1, prose(1), "en", "a", 10), (2, prose(2), "en", "a", None), (2, prose(3), None, None, 3),  # a repeated id
        (3, prose(1), "en", "b", 10),                                     # a copy
        (4, None, "en", "a", None), (5, "", "de", "b", 0), (6, " \t\n ", "de", "b", 4), (7, "one two", "de", "b", 7),
        (None, prose(4), "fr", None, 1), (None, None, None, None, None), (None, prose(4), "fr", None, 1),
        (8, prose(5), "es", "c", 1), (8, prose(5), "es", "c", 1),         # a repeated row
        (9, long, "en", "a", len(long)), (10, "é漢😀 " * 40, "fr", "c", 120),
        (11, prose(1) + " and one more", "en", "c", 9),                   # a near copy
    ]


def frame(spark):
    """The rows, with extra columns named like things the operators make."""
    return (spark.createDataFrame(rows(), SCHEMA).withColumn("id", F.lit("x")).withColumn("kept", F.lit(7)).withColumn("_metrics", F.lit(1))
            .withColumn("text_hash", F.lit(2)).withColumn("node", F.lit(3)).withColumn("n_words", F.lit("w")).withColumn("_kept", F.lit(0)).withColumn("start", F.lit(0)))


def empty(spark):
    return frame(spark).limit(0)
