import random
import re

import numpy as np

from ledgerlink.llm import jaccard_join as op
from ledgerlink.llm.components import components

from .edge_cases import empty, frame, prose, rows

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    """{position: (set size, least id of the class)}."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    classes = {}
    for i, (d, _) in enumerate(docs):
        classes.setdefault(root(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in classes[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(docs)]


def near_copies(r):
    docs, passage = [], " ".join(f"shared{i}" for i in range(40))
    for family in range(25):
        base = [f"f{family}x{r.randrange(60)}" for _ in range(r.choice([4, 5, 6, 12, 60, 150]))]
        for _ in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, max(1, len(w) // 15) + 1)):
                k = r.randrange(len(w))
                w[k:k + 1] = r.choice([[], ["new"], [w[k], "more"], [f"q{r.random()}"]])
            text = " ".join(w) + (" " + passage if r.random() < 0.4 else "")
            docs.append((len(docs) * 3 % 1000, text))
    return docs


def test_classes_match_brute_force(spark):
    docs = near_copies(random.Random(11)) + near_copies(random.Random(12))[:40]
    docs = [(i, t) for i, (_, t) in enumerate(docs)] + [(5000, None), (5001, ""), (5002, " \n"), (None, docs[3][1]), (None, "only here and nowhere else at all"), (5003, "one two"), (5004, "One  TWO")]
    random.Random(1).shuffle(docs)
    got = op.jaccard_classes(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = brute(docs)
    want = [(d, n, c if n else d) for d, n, c in want]
    assert sorted([(r["id"], r["n_runs"], r["component_id"]) for r in got], key=str) == sorted(want, key=str)


def test_threshold_is_met_exactly(spark):
    # 15 windows against 12 of them (12 / 15 links), and against 11 of them (11 / 15 doesn't)
    a = [f"a{i}" for i in range(19)]
    link, no_link = a[:16], a[:15]
    got = {r["id"]: r["component_id"] for r in op.jaccard_classes(spark.createDataFrame([(1, " ".join(a)), (2, " ".join(link))], "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1}
    got = {r["id"]: r["component_id"] for r in op.jaccard_classes(spark.createDataFrame([(1, " ".join(a)), (3, " ".join(no_link))], "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 3: 3}


def test_tree_traversal_leaves_no_link_out():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in r.integers(1, 300, 40)]
    for s in list(sets):
        for share in (0.05, 0.1, 0.2, 0.4):
            keep = r.random(len(s)) > share
            sets.append(np.unique(np.concatenate([s[keep], r.integers(0, 2**63, int(share * len(s) / 4), dtype=np.uint64)])))
    r.shuffle(sets)
    half = len(sets) // 2
    left, right = ([op.Node(n=len(s), bits=int.from_bytes(op.bitmap(s, op.width_of(len(s))), "little"), width=op.width_of(len(s))) for s in x] for x in (sets[:half], sets[half:]))
    place = {id(x): i for x, i in zip([*left, *right], [*range(half), *range(len(right))], strict=True)}
    met = {(place[id(x)], place[id(y)]) for x, y in op.traverse(op.tree(sorted(left, key=lambda m: m.least)), op.tree(sorted(right, key=lambda m: m.least)))}
    want = {(i, j) for i, a in enumerate(sets[:half]) for j, b in enumerate(sets[half:]) if op.linked(a, b)}
    assert want and want <= met and len(met) < half * (len(sets) - half) / 4


def passages(texts, classes=40):
    """Texts of some classes that share a passage of 54 to 60 words but link only inside a class (each text has an end of its own)."""
    docs = []
    for i in range(texts):
        c = i % classes
        words = [f"shared{k}" for k in range(54 + c % 7)] + [f"c{c}w{k}" for k in range(24)]
        docs.append((i, " ".join([*words, f"t{i}", f"u{i}"])))
    return docs


def test_members_listed_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    listed = []
    real = op._survivors

    def counted(pairs):
        listed[-1] += pairs.selectExpr("coalesce(sum(size(left) + size(right)), 0) AS k").first()["k"]
        return real(pairs)

    monkeypatch.setattr(op, "_survivors", counted)
    for n in (300, 600):
        listed.append(0)
        got = op.jaccard_classes(spark.createDataFrame(passages(n), "doc_id bigint, text string")).collect()
        assert all(r["component_id"] == r["id"] % 40 for r in got) and len(got) == n
    assert listed[1] <= 2 * listed[0] + 2 * op.LEAF


def test_large_group_that_does_not_link_matches_brute_force(spark):
    # copies of one text whose edits leave them about the threshold; some links remain, most pairs have none
    r = random.Random(31)
    base = [f"b{i}" for i in range(90)]
    docs = []
    for i in range(260):
        w = list(base)
        for k in r.sample(range(90), r.randrange(1, 7)):
            w[k] = f"x{r.randrange(40)}"
        docs.append((i, " ".join(w)))
    got = op.jaccard_classes(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r["id"], r["n_runs"], r["component_id"]) for r in got) == brute(docs)


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(500, 400 + i) for i in range(30)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in list(parent)}


def test_edge_cases(spark):
    df = frame(spark)
    kept = op.keep_one(df)
    assert kept.columns == df.columns
    got = sorted([(r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect()], key=str)
    copies = {(3, prose(1)), (11, prose(1) + " and one more")}
    want = [(x[0], x[1]) for x in rows()]
    for extra in ((8, prose(5)), (None, prose(4))):
        want.remove(extra)
    assert got == sorted([x for x in want if x not in copies], key=str)
    assert op.keep_one(empty(spark)).count() == 0
    assert op.jaccard_classes(empty(spark)).count() == 0


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    from ledgerlink.llm import components as module
    written = []
    real = module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: written.append(name) or real(df, name))
    rows = module.components(spark.createDataFrame([(5, 1), (1, 7), (9, 3), (4, 4)], "a bigint, b bigint")).collect()
    assert {tuple(r) for r in rows} == {(1, 1), (5, 1), (7, 1), (3, 3), (9, 3)} and written == ["links"]
    path = module.components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a bigint, b bigint")).collect()
    assert {tuple(r) for r in path} == {(i, 0) for i in range(21)}
