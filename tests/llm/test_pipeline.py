import hashlib
import os
import random

import duckdb
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlink.llm import queries
from ledgerlink.llm.byte_bpe import read_ranks

from . import test_decontamination, test_jaccard_join, test_quality_rules, test_secret_scan
from .edge_cases import prose, rows

SF = "/root/testdata/sf0.001"


def corpus(spark, path):
    r = random.Random(21)
    data = [x for x in rows() if x[1] != prose(3)]  # one row of an id, so that ids name classes
    for i in range(100, 260):
        w = prose(i, 120).split()
        r.shuffle(w)
        data.append((i, " ".join(w), ["en", "de"][i % 2], f"s{i % 3}", 1))
    data += [(300 + i, data[20 + i][1] + " tail end", "en", "a", 1) for i in range(20)] + [(400 + i, "### $$$ %%% ".join(prose(i).split()), "en", "s1", 1) for i in range(6)]
    data += [(500 + i, prose(i + 900, 70) + f" password=ab12cd34ef56{i:02d} and " + prose(i + 950, 30), "en", "s2", 1) for i in range(8)]
    bench = [(1, prose(5)), (2, data[60][1][:400]), (3, None), (4, "short one")]
    spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return data, bench


def test_stages_against_plain_versions(spark, scratch):
    data, bench = corpus(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    step = dict(corpus_pipeline.STAGES)
    key = lambda d: sorted(((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()), key=str)
    at = {}
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, scratch)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{scratch}/{name}")
        at[name] = (key(docs), docs)
        docs = spark.read.parquet(f"{scratch}/{name}")
    assert len(step) == 5
    kept = key(spark.read.parquet(f"{scratch}/quality rules"))
    assert all(test_quality_rules.base(t)[0] >= 50 for _, t in kept) and not any(d and 400 <= d < 406 for d, _ in kept) and len(kept) > 150
    # one row of each class, that of the least id
    classes = {}
    for (d, t), c in zip(kept, test_jaccard_join.brute(kept), strict=True):
        classes.setdefault(c[2] if c[2] is not None else t, []).append((d is None, d, t))
    one = key(spark.read.parquet(f"{scratch}/n-gram Jaccard join"))
    assert len(one) == len(classes) and {d for d, _ in one} == {min(v, key=lambda x: (x[0], x[1] or 0))[1] for v in classes.values()}
    bad = test_decontamination.brute(one, bench)
    clean = key(spark.read.parquet(f"{scratch}/benchmark decontamination"))
    assert sorted((b[0] for b in bad if not b[4]), key=str) == sorted((d for d, _ in clean), key=str) and len(clean) < len(one)
    safe = dict(key(spark.read.parquet(f"{scratch}/secret scans")))
    assert len(safe) == len(clean)
    for d, t in clean:
        assert test_secret_scan.base(safe[d]) == [] and (safe[d] == t or test_secret_scan.base(t))
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(read_ranks(path))}, special_tokens={})
    got = docs.collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {d: library.encode_ordinary(t) for d, t in safe.items()} and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    whole = corpus_pipeline.run(spark, scratch)
    digest = lambda d: d.select(F.sum(F.xxhash64("doc_id", "ids").cast("decimal(38,0)")), F.count("*")).first()
    assert digest(whole) == digest(docs)


def test_stages_take_an_empty_table(spark, scratch):
    corpus(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, scratch).count() == 0


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, SF)
        cur = con.execute(sql)
        columns = [c[0] for c in cur.description]
        assert sorted(columns) == sorted(df.columns), name
        assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in df.select(*columns).collect()), name


def test_digest_queries_match_plain_versions(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(read_ranks(path))}, special_tokens={})
    for r in queries.QUERIES["op6_byte_bpe"](spark, SF).collect():
        ids = library.encode_ordinary(docs[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
    lines = {}
    for r in queries.QUERIES["op5_token_counts"](spark, SF).collect():
        lines.setdefault(r["doc_id"], []).append(r)
    assert {d: (len(v), sum(r["n_tokens"] for r in v)) for d, v in lines.items()} == {d: ((t or "").count("\n") + 1, len(library.encode_ordinary(t or ""))) for d, t in docs.items()}
    slots = queries.QUERIES["op7_training_order"](spark, SF).collect()
    assert sorted(r["slot"] for r in slots) == list(range(sum(len(library.encode_ordinary(t or "")) // 512 + 1 for t in docs.values())))
    placed = queries.QUERIES["op3_sharding"](spark, SF).collect()
    assert len(placed) == len(docs) and sum(r["moves"] for r in placed) < len(docs) / 4
    scored = queries.QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(scored) == len(docs) and all(0 <= r["score"] <= 1 for r in scored)
