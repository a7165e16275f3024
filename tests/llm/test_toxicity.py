import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import toxicity as op
from ledgerlink.llm.toxicity_query import op2_toxicity

from .edge_cases import empty, frame, prose, rows

GIVEN = "/root/testdata/sf0.1"
LEAST_AUC, LEAST_F1 = 0.9, 0.8


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_automata_match_brute_force():
    r = random.Random(4)
    terms = ["moron", "idiot", "pathetic", "worthless", "disgusting", "scum", "abcde", "abcdf"]
    lexicon = op.Lexicon(terms, [])
    letters = "abcdefghiopstw"
    for _ in range(4000):
        w = list(r.choice(terms)) if r.random() < 0.7 else [r.choice(letters) for _ in range(r.randrange(1, 12))]
        for _ in range(r.randrange(0, 4)):
            k = r.randrange(len(w) + 1)
            w[k:k + r.randrange(0, 2)] = [r.choice(letters)] * r.randrange(0, 2)
        w = "".join(w)
        want = 1 if w in terms else 3 if any(op.edits(t) and distance(w, t) <= op.edits(t) for t in terms) else 0
        assert lexicon.hit(w) == want, w
    trie = op.Trie({t: op.edits(t) for t in terms})
    assert trie.meets("idiott") and trie.meets("dizgustinng") and not trie.meets("idoitt") and not trie.meets("scun")


def test_signs_quotation_and_address():
    s = op.Scanner((["moron", "idiot", "badst*"], ["weakw"]))
    hits = lambda t: dict(zip(op.FEATURES, np.expm1(s.features(t)).round().tolist(), strict=True))
    assert hits("you are a MORON!")["strong"] == 1 and hits("you are a m0ron, ok")["strong"] == 1 and hits("what an idiiot.")["misspelled"] == 1
    assert hits("badstuff and weakw") | {"density": 0} == dict.fromkeys(op.FEATURES, 0) | {"strong": 1, "weak": 1}
    assert hits("she wrote “what an idiot” there")["quoted_strong"] == 1 and hits("you idiot")["addressed"] == 1
    assert hits("") == hits("nothing here") == dict.fromkeys(op.FEATURES, 0)


def test_terms_joined_by_signs_are_met_as_they_are_learnt():
    s = op.Scanner((["moron", "stupid"], []))
    for word, kinds in (("stupid$$$", [1]), ("stupid/moron", [1, 1]), ("stupid's", [1]), ("stupid,moron", [1, 1]), ("$tupid!", [1]), ("mor.on", [3]), ("st-up", []), ("(stupid)", [1]), ("m0ron", [1])):
        assert s.kinds(word) == kinds, word
    assert np.expm1(s.features("stupid,moron and stupid's " + "x" * 3_000_000)).round()[0] == 3


def test_lexicon_has_no_cap_but_fails_loudly(spark, monkeypatch):
    bad = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) + "qzq" for i in range(2_600)]
    rows = [(1, " ".join(bad))] * 30 + [(0, "calm words")] * 300
    texts = spark.createDataFrame(rows, "toxic int, text string")
    strong, weak = op.lexicon(texts)
    assert set(bad) <= set(strong) and not weak
    monkeypatch.setattr(op, "MOST_TERMS", 100)
    with pytest.raises(ValueError, match="beyond chance"):
        op.lexicon(texts)


def test_repeated_ids_are_bounded_by_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(7, f"{'dolt' if i % 2 else 'calm'} {prose(i, 20)}") for i in range(60)] * 2, "doc_id bigint, text string")
    monkeypatch.setattr(op, "LABELLED", 20)
    seen = []
    monkeypatch.setattr(op, "lexicon", lambda texts: seen.append(texts.count()) or ([], []))
    op.learn(docs, spark.createDataFrame([(7, 1)], "doc_id bigint, toxic int"))
    assert seen == [20]


@pytest.mark.skipif(not os.path.isdir(GIVEN), reason="needs the given tables")
def test_held_out_quality_on_the_given_tables(spark):
    labels = spark.read.parquet(f"{GIVEN}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = op2_toxicity(spark, GIVEN).filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    good, bad = ([r["score"] for r in rows if r["toxic"] == k] for k in (0, 1))
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(good) * len(bad))
    hit = sum(r["predicted"] == r["toxic"] == 1 for r in rows)
    f1 = 2 * hit / (len(bad) + sum(r["predicted"] for r in rows))
    print(f"held out: {len(rows)} texts, {len(bad)} toxic, AUC {auc:.4f}, F1 {f1:.4f}")
    assert len(bad) > 20 and auc >= LEAST_AUC and f1 >= LEAST_F1


def corpus(n=400):
    r = random.Random(7)
    docs, labels = [], []
    bad = ["dolt", "fathead", "nitwit", "grumblebutt", "sprokelfoo", "sprokelbar", "sprokelbaz"]
    for i in range(n):
        words, toxic = prose(i, r.randrange(5, 120)).split(), i % 5 == 0
        for _ in range(r.randrange(2, 6) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        docs.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    d, y = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    terms, weights = op.learn(d, y.filter("doc_id < 300"))
    got = {r["id"]: r for r in op.score(d, terms, weights).collect()}
    assert sum(got[i]["predicted"] == t for i, t in labels if i >= 300) >= 98
    typo = op.score(spark.createDataFrame([(1, prose(3) + " you nitwitt and faathead, nitwti"), (2, prose(3))], "doc_id int, text string"), terms, weights).collect()
    assert typo[0]["score"] > typo[1]["score"] and typo[0]["n_misspelled"] >= 2


def test_edge_cases(spark):
    docs, labels = corpus(100)
    d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").unionByName(frame(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    y = spark.createDataFrame([*labels, (None, 1), (3, None), (2, 1), (2, 0), (4, 0), (5, 0), (10_000, 1)], "doc_id bigint, toxic int")
    terms, weights = op.learn(d, y)
    out = op.score(frame(spark), terms, weights).collect()
    assert len(out) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    plain = {r["score"] for r in out if r["n_terms"] + r["n_misspelled"] + r["n_quoted"] == 0}
    assert len(plain) == 1 and plain.pop() < 0.5
    assert op.score(empty(spark), terms, weights).count() == 0
    for none in (y.limit(0), y.filter("toxic = 0"), y.filter("toxic = 1 and doc_id < 100")):
        terms, weights = op.learn(d, none)
        assert terms == ([], [])
        assert {r["predicted"] for r in op.score(d, terms, weights).collect()} <= {0, 1}
    assert op.learn(empty(spark), y)[0] == ([], [])
