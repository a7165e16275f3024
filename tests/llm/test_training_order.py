import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerlink.llm import training_order as op
from ledgerlink.llm.byte_bpe import read_ranks
from ledgerlink.llm.frames import stage
from ledgerlink.llm.training_order_query import KEY, op7_training_order
from ledgerlink.llm.wordgrams import mix

from .edge_cases import empty, frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENS = read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 100, 1023, 1024, 1025, 50_000])
def test_order_is_a_permutation_that_the_key_decides(n):
    a, b = (op.permute(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a) == list(range(n)) == sorted(b)
    if n >= 100:
        assert (a != b).any() and abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.25


def materialised(spark, docs, length=64, stride=16):
    texts = stage(op.encoded(docs, PATH, public_tokenizers.PATTERN, length=length), "test")
    return op.in_training_order(texts, 5, 2, length=length, stride=stride)


def test_shards_hold_every_sequence_at_its_slot_and_resume(spark, scratch):
    path = f"{scratch}/shards"
    op.write_shards(materialised(spark, frame(spark)), path)
    back = [spark.read.parquet(f).select("slot", "n_tokens", "tokens", "id", "sequence").collect() for f in sorted(spark.read.parquet(path).inputFiles())]
    whole = sorted((r for part in back for r in part), key=lambda r: r["slot"])
    assert [r["slot"] for r in whole] == list(range(len(whole))) and all(len(r["tokens"]) == 128 for r in whole)
    assert all([r["slot"] for r in part] == sorted(r["slot"] for r in part) and len({r["slot"] // 16 for r in part}) == 1 for part in back)
    # put together again by id and place, the texts come out (rows of one id are told apart by their contents)
    want = sorted(tuple([*LIBRARY.encode_ordinary(x[1] or ""), len(TOKENS)]) for x in rows())
    ids = {}
    for r in whole:
        ids.setdefault(r["id"], []).append((r["sequence"], np.frombuffer(r["tokens"], "<u2")[:r["n_tokens"]].tolist()))
    got = [tuple(i for _, p in sorted(parts) for i in p) for k, parts in ids.items() if k in (1, 4, 5, 9, 10)]
    assert all(t in want for t in got) and sum(r["n_tokens"] for r in whole) == sum(map(len, want))
    rest = op.resume(spark, path, 21, stride=16).collect()
    assert [r["slot"] for r in rest] == list(range(21, len(whole)))


def plain_slot(x, n, key):
    """One number through the network in plain integers, again until it lands inside."""
    def mixed(v):
        return int(mix(np.array([v], dtype=np.uint64))[0])
    low = op.bits_for(n) // 2
    high = op.bits_for(n) - low
    while True:
        a, b = high, low
        for r in range(op.ROUNDS):
            left, right = divmod(x, 2**b)
            x, a, b = right * 2**a + (left ^ (mixed((right + mixed((key + r) % 2**64)) % 2**64) % 2**a)), b, a
        if x < n:
            return x


def test_query_reads_back_every_sequence_at_its_plain_slot(spark):
    given = "/root/testdata/sf0.001"
    out = sorted(op7_training_order(spark, given).collect(), key=lambda r: r["slot"])
    texts = dict(spark.read.parquet(f"{given}/documents.parquet").select("doc_id", "text").collect())
    end, fill, n = len(TOKENS), len(TOKENS) + 1, len(out)
    assert [r["slot"] for r in out] == list(range(n)) and all(r["shard"] == r["slot"] // op.STRIDE for r in out)
    number = {plain_slot(i, n, KEY): i for i in range(n)}
    first = {}
    for r in out:
        ids = [*LIBRARY.encode_ordinary(texts[r["doc_id"]] or ""), end]
        part = ids[r["sequence"] * op.LENGTH:(r["sequence"] + 1) * op.LENGTH]
        assert r["n_tokens"] == len(part) > 0
        assert r["tokens_sha256"] == hashlib.sha256(np.array(part + [fill] * (op.LENGTH - len(part)), dtype="<u2").tobytes()).hexdigest()
        # a text's sequences have consecutive numbers
        assert first.setdefault(r["doc_id"], number[r["slot"]] - r["sequence"]) == number[r["slot"]] - r["sequence"]
    assert set(first) == set(texts)


def test_empty_table(spark, scratch):
    none = materialised(spark, empty(spark))
    assert none.count() == 0
    op.write_shards(none, f"{scratch}/none")
    assert op.read_shards(spark, f"{scratch}/none", none).count() == 0
