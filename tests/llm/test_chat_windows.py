import random

from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlink.llm import chat_windows as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "~0~1<|end|>\n<|turn|>user\nx", "<<|", "<", "|>", "~", "[INST]~3", "", None, "é😀" * 20, "<s></s>", "a" * 3000]


def conversations():
    r = random.Random(6)
    out = []
    for c in range(40):
        role = "system" if c % 3 == 0 else "user"
        for t in range(r.randrange(1, 14)):
            out.append((c, t, role, r.choice(HARD) if r.random() < 0.4 else "w " * r.randrange(0, 400)))
            role = r.choice(["user", "assistant", "assistant", "system", "od\nd~6", None])
    return out + [(100, 0, "system", "alone")] + [(101, t, "user" if t % 2 else "assistant", f"turn {t} " * 9) for t in range(3000)] + [(None, None, "user", "x"), (None, 2, "assistant", "y")] + [(102, 1, "user", "same")] * 2


def ordered(rows):
    return sorted(rows, key=lambda r: ((r[1] is not None, r[1]), r[2] or "", r[3] or ""))


def test_read_back_gives_every_turn_once_and_the_mask_every_assistant_text_once(spark):
    data = conversations()
    random.Random(0).shuffle(data)
    windows = op.chat_windows(spark.createDataFrame(data, SCHEMA))
    got = {}
    for r in sorted(op.read_back(windows).collect(), key=lambda r: r["window"]):
        turns, loss = got.setdefault(r["conv"], ([], []))
        turns += [(t["role"], t["text"]) for t in r["turns"]]
        loss += r["loss_texts"]
    want = {}
    for r in data:
        want.setdefault(r[0], []).append(r)
    assert got.keys() == want.keys()
    for c, rows in want.items():
        turns = [(r[2] or "", r[3] or "") for r in ordered(rows)]
        assert got[c][0] == turns, c
        assert got[c][1] == [t for role, t in turns if role == "assistant"], c


def test_windows_keep_to_the_budget_and_repeat_system_and_history(spark):
    data = [(1, 0, "system", "rules")] + [(1, t, "user" if t % 2 else "assistant", f"<{t}> " + "word " * (t % 17)) for t in range(1, 300)]
    rows = sorted(op.chat_windows(spark.createDataFrame(data, SCHEMA), budget=200, history=60).collect(), key=lambda r: r["window"])
    assert len(rows) > 10 and all(r["n_tokens"] <= 200 and not r["over_budget"] for r in rows)
    assert rows[0]["formatted"].startswith("<|turn|>system\nrules<|end|>\n") and all(r["formatted"].startswith("<|context|>system\nrules<|end|>\n") for r in rows[1:])
    for before, r in zip(rows, rows[1:], strict=False):
        history = [p for p in r["formatted"].split("<|end|>\n") if p.startswith("<|context|>")][1:]
        earlier = [p.split("|>", 1)[1] for p in before["formatted"].split("<|end|>\n") if p]
        assert history and [p.split("|>", 1)[1] for p in history] == earlier[-len(history):]
        texts = [r["formatted"][s["start"]:s["end"]] for s in r["loss"]]
        assert all("<" in t for t in texts) and not any(t and f"assistant\n{t}" in "".join(history) for t in texts)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="~<|>s/[]INST0123456e\n", max_size=25), min_size=1, max_size=40))
def test_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", op.escape(F.col("t")).alias("e"), op.unescape(op.escape(F.col("t"))).alias("back")).collect()
    for r in rows:
        assert r["back"] == r["t"] and not any(raw in r["e"] for raw, _ in op.ESCAPES[1:])


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    assert op.chat_windows(df.limit(0)).count() == 0
    more = df.withColumn("conv", F.lit(1)).withColumn("start", F.lit(1)).withColumn("tokens", F.lit("t")).withColumn("window", F.lit(0))
    assert op.chat_windows(more).first()["formatted"] == "<|turn|>user\nx<|end|>\n"
