import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlink.llm import byte_bpe as op

from .edge_cases import empty, frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENS = op.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
OURS = op.Encoder(op.sentencepiece_model(TOKENS), TOKENS, public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aàb ▁<>|s/\n\t'", max_size=40))
def test_same_ids_as_the_library(text):
    assert OURS.encode([text]) == [LIBRARY.encode_ordinary(text)]


def test_every_byte_maps_back():
    assert op.as_bytes(op.as_text(bytes(range(256)))) == bytes(range(256))


def test_ranks_with_gaps_are_refused(tmp_path):
    (tmp_path / "v").write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="without gaps"):
        op.read_ranks(str(tmp_path / "v"))


def test_edge_cases(spark):
    df = frame(spark)
    out = op.decode(op.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    assert out.columns == [*df.columns, "ids", "decoded"]
    got = sorted([(r["doc_id"], r["text"], r["ids"], bytes(r["decoded"])) for r in out.collect()], key=str)
    assert got == sorted([(x[0], x[1], LIBRARY.encode_ordinary(x[1] or ""), (x[1] or "").encode()) for x in rows()], key=str)
    assert op.decode(op.encode(empty(spark), PATH, public_tokenizers.PATTERN), PATH).count() == 0
    named = df.withColumn("IDS", F.lit("own")).withColumn("decoded", F.lit(1))
    back = op.decode(op.encode(named, PATH, public_tokenizers.PATTERN), PATH, ids_col="_ids")
    assert back.columns == [*named.columns, "_ids", "_decoded"]
    assert all(r["IDS"] == "own" and r["decoded"] == 1 and bytes(r["_decoded"]).decode() == (r["text"] or "") for r in back.collect())
    long = spark.createDataFrame([("a" * 200_000 + " b" * 100_000,)], "text string")
    assert op.encode(long, PATH, public_tokenizers.PATTERN).first()["ids"] == LIBRARY.encode_ordinary(long.first()[0])
    none = op.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH)
    assert [bytes(r["decoded"]) for r in none.collect()] == [b"", b""]
