"""Pruned pairs, stable matching and key succession against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import linkage as L
from ledgerlink.operators import pruning
from ledgerlink.operators.matching import stable_partners
from ledgerlink.operators.succession import component_labels, entity_succession

NAME = "clean_name_{0} string, row_id_{0} string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    a, b = (" ".join(sorted(x.split(" "))) for x in (a, b))
    return (1.0 - (len(a) + len(b) - 2 * lcs(a, b)) / (len(a) + len(b))) * 100.0


def names(spark, sfx, values):
    return spark.createDataFrame([(v, f"r{i}") for i, v in enumerate(values)], NAME.format(sfx))


def company_names(rng, n):
    out = set()
    while len(out) < n:
        words = [rng.choice(["block one", "block two", "blockade"])] + ["".join(rng.choice("aabeiorstz09") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 3))]
        out.add(" ".join(words))
    out.add("block one " + "a" * 90)  # more occurrences than the signature has bits
    out.add("block one " + "a" * 84 + "b")
    return sorted(out)


@pytest.mark.parametrize("threshold", [30.0, 72.5, 85.0, 100.0])
@pytest.mark.parametrize("pairs_per_task", [None, 20])  # 20: by indexed elements, in a grid
def test_no_passing_pair_is_lost(spark, threshold, pairs_per_task):
    rng = random.Random(int(threshold))
    a, b = company_names(rng, 60), company_names(rng, 60)
    pairs = L.pruned_pairs(names(spark, "s1", a), names(spark, "s2", b), threshold, pairs_per_task=pairs_per_task).select("clean_name_s1", "clean_name_s2").collect()
    got = {tuple(r) for r in pairs}
    assert len(got) == len(pairs)  # each pair once
    want = {(x, y) for x in a for y in b if x[:6] == y[:6] and ratio(x, y) >= threshold}
    assert want <= got
    counts = lambda x: {c: min(x.count(c), 5) for c in set(x)}
    for x, y in got:  # and what is left has the characters
        cx, cy = counts(x), counts(y)
        common = sum(min(n, cy.get(c, 0)) for c, n in cx.items()) + min(len(x) - sum(cx.values()), len(y) - sum(cy.values()))
        assert common >= (len(x) + len(y)) * threshold / 200 - 1e-6
    if threshold > 80:
        assert len(got) < len(a) * len(b) / 10


def test_elements_are_numbered_characters(spark):
    df = spark.createDataFrame([("aab a",), ("",)], "n string").select(pruning.elements(F.col("n")).alias("e"))
    place = {c: pruning.CHARACTERS.index(c) + 1 for c in "ab "}
    assert df.first()["e"] == sorted([place["a"] - 64 * k for k in (1, 2, 3)] + [place["b"] - 64, place[" "] - 64])
    assert sorted(pruning.CHARACTERS) == sorted("abcdefghijklmnopqrstuvwxyz0123456789 ")


def test_small_blocks_are_joined_whole(spark):
    """Each name is shuffled once there, without copies for length bands; the pairs are those of the bands."""
    rng = random.Random(4)
    n1, n2 = names(spark, "s1", company_names(rng, 50)), names(spark, "s2", company_names(rng, 50))
    whole, bands = (L.pruned_pairs(n1, n2, 60.0, whole_block_pairs=n) for n in (1 << 16, 0))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_band" in plan(bands) and "_band" not in plan(whole)
    rows = sorted(map(tuple, whole.collect()))
    assert rows and rows == sorted(map(tuple, bands.collect()))


def test_signatures_of_a_batch(spark):
    """Counted for all names of an Arrow batch as by the expressions, name by name."""
    rng = random.Random(8)
    texts = ["", "q" * 9, "a\u00e9 \U0001f600 zz", "0 " * 70] + ["".join(rng.choice(pruning.CHARACTERS + "aaa\u00e9") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "n string").withColumn("len", F.char_length("n")).withColumn("c", pruning.occurrences("n"))
    for r in df.select("n", pruning.signature("c", "len").alias("one"), pruning.signature_arrow("n").alias("all")).collect():
        assert r["one"] == r["all"], r["n"]


def test_both_ways_of_meeting_give_the_same_entities(spark):
    from ledgerlink.sources import fixtures
    s1, s2 = fixtures.company_sources(spark, "/root/testdata/sf0.001")
    plain, indexed = (L.resolve_entities(s1, s2, 70.0, pairs_per_task=n) for n in (None, 1))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, indexed.collect()))


def plain_matching(pairs):
    """Proposals one by one: each free name of the first side asks its best partner that it hasn't asked."""
    prefs, held, asked = {}, {}, {}
    for (a, b), s in pairs.items():
        prefs.setdefault(a, []).append((-s, b))
    free = list(prefs)
    for a in prefs:
        prefs[a].sort()
        asked[a] = 0
    while free:
        a = free.pop()
        if asked[a] == len(prefs[a]):
            continue
        b = prefs[a][asked[a]][1]
        asked[a] += 1
        if b not in held or (-pairs[a, b], a) < (-pairs[held[b], b], held[b]):
            if b in held:
                free.append(held[b])
            held[b] = a
        else:
            free.append(a)
    return {(a, b, pairs[a, b]) for b, a in held.items()}


@pytest.mark.parametrize("seed", range(4))
def test_stable_matching(spark, seed):
    rng = random.Random(seed)
    pairs = {(f"a{rng.randrange(14):02d}", f"b{rng.randrange(10):02d}"): float(rng.choice([50, 60, 60, 70, 80, 90])) for _ in range(70)}
    pairs |= {(f"h{i:02d}", "b00"): 65.0 for i in range(30)}  # a hot partner, all ties
    df = spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()], "clean_name_s1 string, clean_name_s2 string, name_score double")
    got = {tuple(r) for r in stable_partners(df, 55.0).collect()}
    pairs = {k: s for k, s in pairs.items() if s >= 55.0}
    assert got == plain_matching(pairs)
    mine, theirs = {a: (b, s) for a, b, s in got}, {b: (a, s) for a, b, s in got}
    for (a, b), s in pairs.items():  # no pair would rather have each other
        better_for_a = a not in mine or (-s, b) < (-mine[a][1], mine[a][0])
        better_for_b = b not in theirs or (-s, a) < (-theirs[b][1], theirs[b][0])
        assert not (better_for_a and better_for_b)


def test_stable_matching_of_nothing(spark):
    df = spark.createDataFrame([], "clean_name_s1 string, clean_name_s2 string, name_score double")
    assert stable_partners(df, 85.0).count() == 0


def test_a_loser_keeps_its_second_choice(spark):
    s1 = spark.createDataFrame([(n, None, None, None) for n in ("abcdefgh ab", "abcdefgh ac")], "corporate_name_s1 string, address string, activity_places string, top_suppliers string")
    s2 = spark.createDataFrame([(n, None, 1.0, 1.0) for n in ("abcdefgh a", "abcdefgh")], "corporate_name_s2 string, main_customers string, revenue double, profit double")
    out = {r["clean_name_s1"]: r["clean_name_s2"] for r in L.resolve_entities(s1, s2, 80.0, one_to_one=True).collect()}
    assert out == {"abcdefgh ab": "abcdefgh a", "abcdefgh ac": "abcdefgh"}


def test_component_labels(spark):
    links = [("n09", "n08"), ("n08", "n07"), ("n01", "n02"), *[(f"m{i:02d}", f"m{i + 1:02d}") for i in range(40)], *[("hub", f"z{i}") for i in range(50)]]
    got = dict(map(tuple, component_labels(spark.createDataFrame(links, "a string, b string")).collect()))
    assert {got[x] for x in ("n07", "n08", "n09")} == {"n07"} and got["n02"] == "n01"
    assert {got[f"m{i:02d}"] for i in range(41)} == {"m00"} and {got[f"z{i}"] for i in range(50)} == {"hub"}


def test_kinds_of_succession(spark):
    schema = "corporate_id string, clean_name_s1 string, clean_name_s2 string, row_id_s1 string, row_id_s2 string"
    old = [("K", "kept", None, "1", None), ("Y", None, "y", None, "2"), ("X", "x", None, "3", None),  # Y joins X: merged
           ("R", None, "r", None, "4"),                                                            # renamed to P
           ("S", "s", "t", "5", "6"),                                                              # split into S1 and T
           ("G", "gone", None, "7", None), ("B", "", None, "blank1", None), ("C", "", None, "blank2", None),
           ("M", "m", "w", "8", "9"), ("N", "n", "w", "10", "9"),                                   # regrouped
           ("H", "h", "h2", "11", "12")]                                                           # one successor with both names
    new = [("K", "kept", None, "1", None), ("X", "x", "y", "3", "2"), ("P", "p", "r", "20", "4"), ("S1", "s", None, "5", None), ("T", None, "t", None, "6"),
           ("C2", "", None, "blank2", None), ("V1", "m", None, "8", None), ("V2", "n", "w", "10", "9"), ("H2", "h", "h2", "11", "12")]
    out = {r["stale_id"]: tuple(r)[1:] for r in entity_succession(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)).collect()}
    assert out == {"Y": ("X", 1, "merged", 2, 1), "R": ("P", 1, "renamed", 1, 1), "S": ("S1", 2, "split", 1, 2), "G": (None, 0, "gone", 1, 0),
                   "B": (None, 0, "gone", 1, 0), "C": ("C2", 1, "renamed", 1, 1), "M": ("V1", 2, "regrouped", 2, 2), "N": ("V2", 1, "regrouped", 2, 2),
                   "H": ("H2", 1, "renamed", 1, 1)}
    empty = spark.createDataFrame([], schema)
    assert entity_succession(empty, empty).count() == 0


def test_unchanged_keys_are_no_part_of_the_succession_graph(spark):
    from ledgerlink.operators.succession import _names, _open_rows
    schema = "corporate_id string, clean_name_s1 string, clean_name_s2 string, row_id_s1 string, row_id_s2 string"
    same = [(f"K{i}", f"n{i}", f"m{i}", f"{i}", f"{i}") for i in range(50)]
    old = spark.createDataFrame([*same, ("G", "gone", None, "g", None), ("R", None, "r", None, "r")], schema)
    new = spark.createDataFrame([*same, ("P", "p", "r", "p", "r"), ("F", "fresh", None, "f", None)], schema)
    assert {tuple(r) for r in _open_rows(_names(old), _names(new)).collect()} == {("old", "R", "s2:r"), ("new", "P", "s2:r"), ("new", "P", "s1:p")}
    out = {tuple(r) for r in entity_succession(old, new).collect()}
    assert out == {("G", None, 0, "gone", 1, 0), ("R", "P", 1, "renamed", 1, 1)}
