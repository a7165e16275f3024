"""Regex-based cleaning equals the token model on random text (property test)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.functions.text import (
    ADDRESS_ABBREVIATIONS, CORPORATE_SUFFIXES, clean_name, list_size, normalize_address, parse_list,
)

WORDS = ["acme", "inc", "Inc.", "corp", "CO", "co.", "ltd", "Limited", "llc", "street", "Road", "avenue",
         "drive", "blvd", "boulevard", "incorporated", "coop", "42", "a1", "x"]
SEPARATORS = [" ", "  ", ", ", ".", "-", "\t", "\u00a0", "\u2003", "\x1f", "/", "(", ")", "é", "ß", "|", " | ", "||", ""]
text = st.lists(st.one_of(st.sampled_from(WORDS), st.sampled_from(SEPARATORS)), max_size=12).map("".join)


def model_tokens(s):
    s = (s or "").lower().strip()
    s = re.sub(r"[^a-z0-9\s]", " ", s)
    return s.split()


def model_clean(s):
    return " ".join(t for t in model_tokens(s) if t not in CORPORATE_SUFFIXES)


def model_address(s):
    return " ".join(ADDRESS_ABBREVIATIONS.get(t, t) for t in model_tokens(s))


def model_list(s):
    return [p.strip() for p in (s or "").split("|") if p.strip()]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), text), min_size=300, max_size=300))
def test_cleaning_matches_token_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", clean_name("v").alias("c"), normalize_address("v").alias("a"),
                    parse_list("v").alias("l"), list_size("v").alias("n")).collect()
    for r in got:
        assert r["c"] == model_clean(r["v"]), r["v"]
        assert r["a"] == model_address(r["v"]), r["v"]
        assert r["l"] == model_list(r["v"]), r["v"]
        assert r["n"] == len(model_list(r["v"])), r["v"]
