import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from ledgerlink.llm import quality_rules as op
from ledgerlink.llm.quality_rules_query import SQL, op10_quality_rules

from .edge_cases import empty, frame, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    t = text or ""
    words = WORD.findall(t)
    lines = [s for s in t.split("\n") if WORD.search(s)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def texts():
    r = random.Random(5)
    out = [x[1] for x in rows()]
    for _ in range(60):
        n = r.randrange(0, 40)
        out.append("".join(r.choice(["a", "b", "ab", "é", "#", "$x"]) + r.choice([" ", " ", "\n", "\t", "\x0b", "\n\n"]) for _ in range(n)))
    return out + ["a a a", "a a a a", "a b c a b c", "\n\n", "a\na\n a", "   x"]


def test_counts_match_a_plain_version(spark):
    given = texts()
    df = spark.createDataFrame(list(enumerate(given)), "i int, text string")
    got = {r["i"]: tuple(r["m"])[:5] for r in op.with_metrics(df, "m").collect()}
    assert got == {i: base(t) for i, t in enumerate(given)}


def test_sketches_merge_to_the_sketch_of_all(spark):
    df = op.with_metrics(spark.createDataFrame([(i, "en", f"s{i % 3}", prose(i) + " ##" * (i % 7)) for i in range(60)], "i int, lang string, source string, text string"), "m")
    whole = op.quantile_sketch(df, "m", ["lang"])
    parts = [op.quantile_sketch(df.filter(F.col("source") == s), "m", ["lang"]) for s in ("s0", "s1", "s2")]
    merged = op.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g0"])
    key = lambda d: sorted((r["g0"], r["metric"], r["bucket"], r["n"]) for r in d.collect())
    assert key(whole) == key(merged)


def test_fence_adapts_to_its_group(spark):
    # symbols are usual in one source and rare in the other
    data = [(i, "en", "code", prose(i) + " <a> &" * 12) for i in range(150)] + [(1000 + i, "en", "news", prose(i)) for i in range(300)] + [(5000, "en", "news", prose(9) + " <a> &" * 12)]
    df = spark.createDataFrame(data, "doc_id int, lang string, source string, text string")
    out, _, kept = op.quality_rules(df, ["lang", "source"])
    verdict = {r["doc_id"]: r[kept] for r in out.collect()}
    assert not verdict[5000]
    assert all(verdict[1000 + i] for i in range(300))


def symbols(i, per_thousand):
    """A text of which about so many thousandths of the characters are symbols."""
    text = prose(i)
    return text + " " + "#" * (len(text.replace(" ", "")) * per_thousand // (1000 - per_thousand))


def skewed(spark):
    # junk holds a third of the rows and of its language; a clean source with many symbols holds a fiftieth
    r = random.Random(3)
    data = [(i, "en", f"s{i % 4}", prose(i)) for i in range(4000)]
    data += [(10_000 + i, "en", "junk", symbols(i, r.choice([105, 115, 340, 365, 380]))) for i in range(2100)]
    data += [(20_000 + i, "en", "code", symbols(i, 118 + i % 5)) for i in range(126)]
    return spark.createDataFrame(data, "doc_id int, lang string, source string, text string")


def test_no_source_moves_its_own_reference(spark):
    kept = {x["source"]: x["count"] for x in op.quality_filter(skewed(spark), ["lang", "source"]).groupBy("source").count().collect()}
    assert kept == {"s0": 1000, "s1": 1000, "s2": 1000, "s3": 1000, "code": 126}


def test_query_and_sql_on_skewed_sources(spark, scratch):
    skewed(spark).write.parquet(f"{scratch}/documents.parquet")
    got = sorted(map(tuple, op10_quality_rules(spark, scratch).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(SQL).fetchall())
    assert not any(r[-1] for r in got if 10_000 <= r[0] < 20_000) and all(r[-1] for r in got if not 10_000 <= r[0] < 20_000)


def test_a_junk_language_does_not_move_its_own_reference(spark):
    data = [(i, ["en", "fr"][i % 2], "a", prose(i)) for i in range(400)] + [(1000 + i, "xx", f"j{i % 2}", symbols(i, 250 + i % 100)) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id int, lang string, source string, text string")
    kept = {x["lang"]: x["count"] for x in op.quality_filter(df, ["lang"]).groupBy("lang").count().collect()}
    assert kept == {"en": 200, "fr": 200}


def test_edge_cases(spark):
    df = frame(spark)
    kept = op.quality_filter(df, ["lang", "source"])
    assert kept.columns == df.columns
    found = kept.select("doc_id", "text").collect()
    assert {(r[0], r[1]) for r in found} <= {(x[0], x[1]) for x in rows()}
    assert all(base(r[1])[0] >= 50 for r in found)
    assert sum(r[0] == 8 for r in found) == 2  # repeated rows are judged alike, and both stay
    assert op.quality_filter(empty(spark), ["lang", "source"]).count() == 0
