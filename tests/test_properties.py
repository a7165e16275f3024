"""Property tests: upsert vs a dictionary model, salt grid forms every pair exactly once."""

from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.operators import linkage as L
from ledgerlink.operators.upsert import merge_upsert, merge_upsert_legacy
from ledgerlink.schemas import REGISTRY_SCHEMA

TS = datetime(2024, 1, 1)
keys = st.sampled_from([f"k{i}" for i in range(12)])
row = st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["exact_name", "fuzzy_name", "source1_only"]))


def frame(spark, d):
    rows = [(k, name, "", "", "", "", 1.0, 2.0, 100.0, True, False, TS, "b", mt) for k, (name, mt) in d.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(keys, row, max_size=8), st.dictionaries(keys, row, max_size=8))
def test_upsert_matches_dictionary_model(spark, target, staged):
    got = {r["corporate_id"]: (r["canonical_name"], r["match_type"])
           for r in merge_upsert(frame(spark, target), frame(spark, staged)).collect()}
    assert got == {**target, **staged}
    legacy = {r["corporate_id"]: (r["canonical_name"], r["match_type"])
              for r in merge_upsert_legacy(frame(spark, target), frame(spark, staged)).collect()}
    want = dict(target)
    for k, (name, mt) in staged.items():
        want[k] = (name, target[k][1]) if k in target else (name, mt)
    assert legacy == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 25), st.integers(1, 25)), min_size=1, max_size=4), st.integers(1, 60))
def test_salt_grid_forms_each_pair_once(spark, sizes, budget):
    left_rows, right_rows = [], []
    for key, (n1, n2) in enumerate(sizes):
        left_rows += [(f"b{key}", 0, f"l{key}_{i}") for i in range(n1)]
        right_rows += [(f"b{key}", 0, f"r{key}_{j}") for j in range(n2)]
    left = spark.createDataFrame(left_rows, "block string, _band int, clean_name_s1 string")
    right = spark.createDataFrame(right_rows, "block string, _band int, clean_name_s2 string")
    lg, rg, k = L._salt_grid(left, right, ["block", "_band"], budget)
    pairs = lg.join(rg, k).select("clean_name_s1", "clean_name_s2")
    expected = sum(n1 * n2 for n1, n2 in sizes)
    assert pairs.count() == expected
    assert pairs.distinct().count() == expected
