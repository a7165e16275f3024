import random
import re

from ledgerlink.llm import decontamination as op

from .edge_cases import empty, frame, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    found = op.contamination(d, b).collect()
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
        assert r["n_items"] == len(r["items"])
    return sorted([(r["id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found], key=str)


def test_matches_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["a", "b", "Cc", "dé", "e1"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 5, 6, 7, 12, 13, 14, 20, 30, 0])] + [(50, None), (51, prose(3)), (52, prose(3))]
    docs = []
    for i in range(60):
        parts = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 60)))]
        w = items[r.randrange(len(items) - 3)][1].split()
        a = r.randrange(0, max(1, len(w)))
        parts += ["-".join(w[a:a + r.randrange(10, 16)]), prose(i)]
        r.shuffle(parts)
        docs.append((i, "; ".join(parts)))
    docs += [(100, None), (100, ""), (101, prose(3)), (102, "x " * 5000 + prose(3).upper()), (None, prose(3)), (None, None), (101, prose(3)), (103, "a" + " a" * 500)]
    assert run(spark, docs, items) == brute(docs, items)


def test_every_shared_span_of_the_window_is_found(spark):
    item = " ".join(f"w{i}" for i in range(60))
    docs = [(i, " ".join(["zz"] * (i % 9) + item.split()[i:i + 13] + ["yy"] * 3)) for i in range(48)] + [(100 + i, " ".join(item.split()[i:i + 12] + ["yy"])) for i in range(48)]
    found = {r[0]: r[2] for r in run(spark, docs, [(1, item)])}
    assert all(found[i] == 13 for i in range(48)) and not any(found[100 + i] for i in range(48))


def test_edge_cases(spark):
    df = frame(spark)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert sorted(op.decontaminate(df, none).select("doc_id", "text").collect(), key=str) == sorted(df.select("doc_id", "text").collect(), key=str)
    bench = spark.createDataFrame([(1, prose(5)), (None, prose(5))], "item_id bigint, text string")
    kept = op.decontaminate(df, bench)
    assert kept.columns == df.columns and kept.filter("doc_id = 8").count() == 0 and kept.filter("doc_id = 2").count() == 2
    assert op.decontaminate(empty(spark), bench).count() == 0
