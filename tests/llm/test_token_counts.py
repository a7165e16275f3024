import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlink.llm import token_counts as op
from ledgerlink.llm.byte_bpe import read_ranks

from .edge_cases import empty, frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(read_ranks(PATH))}, special_tokens={})


def plain(text, bounds, rule):
    """Thousandths of tokens by section, byte by byte."""
    section = [next(k for k in range(len(bounds) - 1) if bounds[k] <= i < bounds[k + 1]) for i in range(bounds[-1])]
    counts, at = [0] * (len(bounds) - 1), 0
    for token in LIBRARY.encode_ordinary(text):
        held = section[at:at + len(LIBRARY.decode_single_token_bytes(token))]
        at += len(held)
        if rule == "first":
            counts[held[0]] += 1000
        elif rule == "last":
            counts[held[-1]] += 1000
        elif rule == "most":
            counts[max(dict.fromkeys(held), key=held.count)] += 1000
        else:
            share = {k: 1000 * held.count(k) // len(held) for k in dict.fromkeys(held)}
            share[held[0]] += 1000 - sum(share.values())
            for k, v in share.items():
                counts[k] += v
    return counts


def texts():
    r = random.Random(9)
    return ["".join(r.choice(["\n", "\n", " ", "word", "é", "😀", "  ", "x1", ".\n"]) for _ in range(r.randrange(0, 50))) for _ in range(80)]


@pytest.mark.parametrize("rule", op.RULES)
def test_matches_a_plain_version(spark, rule):
    given = texts()
    got = {}
    for r in op.section_tokens(spark.createDataFrame(list(enumerate(given)), "doc_id int, text string"), PATH, public_tokenizers.PATTERN, rule=rule).collect():
        got.setdefault(r["id"], {})[r["section"]] = (r["start"], r["end"], r["tokens"], r["text_tokens"])
    for i, t in enumerate(given):
        data = t.encode()
        bounds = [0] + [k + 1 for k, c in enumerate(data) if c == 10] + [len(data)]
        want = plain(t, bounds, rule)
        assert [got[i][k] for k in range(len(bounds) - 1)] == [(a, b, n, len(LIBRARY.encode_ordinary(t))) for a, b, n in zip(bounds, bounds[1:], want, strict=False)]


def test_fields(spark):
    df = spark.createDataFrame([(1, "Title of it", None, "body é of the thing"), (2, "", "", "")], "doc_id int, a string, b string, c string")
    text, bounds = op.joined_fields([F.col("a"), F.col("b"), F.col("c")])
    out = op.section_tokens(df.withColumn("text", text).withColumn("bounds", bounds), PATH, public_tokenizers.PATTERN, bounds_col="bounds").orderBy("id", "section").collect()
    assert [r["end"] - r["start"] for r in out] == [11, 0, 20, 0, 0, 0]
    assert out[1]["tokens"] == 0 and sum(r["tokens"] for r in out[:3]) == 1000 * out[0]["text_tokens"]


def test_edge_cases(spark):
    out = op.section_tokens(frame(spark), PATH, public_tokenizers.PATTERN).collect()
    assert len(out) == sum((x[1] or "").count("\n") + 1 for x in rows())
    assert sum(r["tokens"] for r in out) == 1000 * sum(len(LIBRARY.encode_ordinary(x[1] or "")) for x in rows())
    assert op.section_tokens(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="rule"):
        op.section_tokens(frame(spark), PATH, public_tokenizers.PATTERN, rule="none")
