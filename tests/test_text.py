import pytest
from pyspark.sql import functions as F

from ledgerlink.functions.text import block_key, clean_name, list_size, normalize_address, parse_list, sort_tokens


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw", ["CO. QUAY foundry", "Quay / Foundry (Limited)", "quay-foundry ltd", "Inc Quay Corporation Foundry"])
def test_spellings_clean_to_one_key(spark, raw):
    assert one(spark, clean_name, raw) == "quay foundry"


@pytest.mark.parametrize("raw,expected", [
    (None, ""), ("", ""), ("   ", ""), ("Inc", ""), ("株式会社", ""),
    ("Limited  Brands Co. Ltd", "brands"),          # suffix tokens dropped anywhere, not only at the end
    ("ACME-Widgets (EU) 42", "acme widgets eu 42"),
    ("Co-operative Bank", "operative bank"),
])
def test_clean_name_edges(spark, raw, expected):
    assert one(spark, clean_name, raw) == expected


def test_normalize_address(spark):
    assert one(spark, normalize_address, "12 Main Street, Springfield Road") == "12 main st springfield rd"
    assert one(spark, normalize_address, None) == ""
    assert one(spark, normalize_address, "Avenue-Boulevard Drive") == "ave blvd dr"


@pytest.mark.parametrize("raw,items", [
    (None, []), ("", []), ("a|b", ["a", "b"]), ("a||b", ["a", "b"]), (" a | b ", ["a", "b"]), ("|", []),
])
def test_parse_list(spark, raw, items):
    assert one(spark, parse_list, raw) == items
    assert one(spark, list_size, raw) == len(items)


def test_block_and_sort(spark):
    assert one(spark, lambda c: block_key(c, 6), "acme widgets") == "acme w"
    assert one(spark, lambda c: block_key(c, 6), "abc") == "abc"
    assert one(spark, sort_tokens, "world hello 42") == "42 hello world"


@pytest.mark.parametrize("raw,items", [
    ("a b|c", ["a b", "c"]), ("a\t|b", ["a", "b"]), ("a| b", ["a", "b"]), ("　a|b ", ["a", "b"]), ("é x|b\n", ["é x", "b"]),
    ("a b|c |d", ["a b", "c", "d"]), ("a|b|", ["a", "b"]), (" ", []), ("|a", ["a"]), ("a\tb|c", ["a\tb", "c"]),
])
def test_lists_that_need_trimming_or_not(spark, raw, items):
    assert one(spark, parse_list, raw) == items
    assert one(spark, list_size, raw) == len(items)


def test_a_tidy_list_is_only_searched(spark):
    """What has nothing to trim or drop is told apart without a look at each item."""
    from ledgerlink.functions.text import _untidy
    rows = [("a|b", False), ("SAUDI ARABIA|é x", False), ("", True), ("a||b", True), ("a| b", True), ("a |b", True), ("a|", True), ("a |b", True)]
    got = spark.createDataFrame(rows, "v string, w boolean").select("w", _untidy(F.col("v")).alias("u")).collect()
    assert all(r["u"] == r["w"] for r in got)
