import hashlib
import random
import zlib

import numpy as np

from ledgerlink.llm import periodic_runs as op
from ledgerlink.llm.periodic_runs_query import op12_periodic_runs
from .edge_cases import empty, frame

SF = "/root/testdata/sf0.001"


def plain_runs(w):
    """All maximal stretches of every period, those of smallest period and four periods kept."""
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                s, m = i - q, j - i + q
                if not any(all(w[s + k] == w[s + k - d] for k in range(d, m)) for d in range(1, q)):
                    found.append((s, m, q))
            i = j + 1
    return sorted(found)


def plain(doc_id, text):
    words = [x for x in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(b"%d" % doc_id) % 10 == 0:
        g = zlib.crc32(b"%d" % doc_id) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-(r[1] * 10**9 // r[2]), r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(words) if i not in gone).encode()).hexdigest())


def sequences(seed, count, longest):
    rng = random.Random(seed)
    for _ in range(count):
        n, k = rng.randint(0, longest), rng.randint(1, 4)
        w = [rng.randrange(k) for _ in range(n)]
        if n > 10 and rng.random() < 0.8:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            w[a:] = [w[a + (i - a) % p] for i in range(a, n)]
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(n)] = rng.randrange(k)
        yield w


def test_runs_against_all_periods():
    for w in [*sequences(1, 3000, 50), *sequences(2, 200, 300)]:
        assert op.find_runs(np.array(w, np.int64)) == plain_runs(w), w


def test_each_access_names_the_longest_repeat_of_every_distance():
    for w in sequences(3, 300, 40):
        automaton, ends = op.LinkCutAutomaton(), {}
        for i, letter in enumerate(w):
            want = {}
            for length in range(1, i + 2):
                s = tuple(w[i - length + 1:i + 1])
                if s in ends:
                    want[i - ends[s]] = max(want.get(i - ends[s], 0), length)
                ends[s] = i
            assert dict(automaton.append(letter)) == want


def test_long_texts_and_single_words():
    assert op.find_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    w = np.concatenate([np.arange(5_000), np.tile(np.arange(5_000, 6_000), 7), np.arange(6_000, 9_000)])
    assert op.find_runs(w) == [(5_000, 7_000, 1_000)]
    assert op.find_runs(np.tile(np.arange(5), 4)[:-1]) == [] and op.find_runs(np.tile(np.arange(5), 4)) == [(0, 20, 5)]
    assert op.find_runs(np.zeros(5, np.int64)) == [] and op.find_runs(np.zeros(6, np.int64)) == [(0, 6, 1)]


def test_query_against_plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], *plain(r["doc_id"], r["text"] or "")) for r in docs if len(r["text"] or "") < 20_000)
    short = {x[0] for x in want}
    rows = op12_periodic_runs(spark, SF).collect()
    assert len(rows) == len(docs)
    assert sorted(tuple(r) for r in rows if r["doc_id"] in short) == want
    assert sum(r["n_runs"] > 0 for r in rows) > 10


def test_edge_rows(spark):
    docs = frame(spark)
    out = op.periodic_runs(docs.withColumnRenamed("node", "RUNS"), result_col="runs")
    assert "_runs" in out.columns and "RUNS" in out.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = sorted(((r["doc_id"], r["text"], tuple(r["_runs"])) for r in out.collect()), key=key)
    want = sorted(((r["doc_id"], r["text"], plain(None, r["text"] or "")) for r in docs.collect()), key=key)
    assert got == want
    assert op.periodic_runs(empty(spark)).count() == 0
