import random


from ledgerlink.functions.similarity import lcs_length, token_sort_ratio


def lcs_dp(a: str, b: str) -> int:
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    return (1.0 - (len(a) + len(b) - 2 * lcs_dp(a, b)) / (len(a) + len(b))) * 100.0


def test_hand_worked_pairs(spark):
    df = spark.createDataFrame([("acme 123", "acme 124"), ("abc", "xyz"), ("hello world", "hello world"),
                                ("", "abc")], "a string, b string")
    got = [r["s"] for r in df.select(token_sort_ratio("a", "b").alias("s")).collect()]
    assert got == [87.5, 0.0, 100.0, 0.0]


def test_lcs_matches_dynamic_programming_across_word_boundaries(spark):
    rng = random.Random(7)
    alphabet = "abcde "
    lengths = [1, 2, 5, 61, 62, 63, 64, 100, 124, 125, 130, 200]
    rows = []
    for _ in range(120):
        la, lb = rng.choice(lengths), rng.choice(lengths)
        rows.append(("".join(rng.choice(alphabet) for _ in range(la)), "".join(rng.choice(alphabet) for _ in range(lb))))
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", lcs_length("a", "b").alias("l")).collect()
    for r in got:
        assert r["l"] == lcs_dp(r["a"], r["b"]), (len(r["a"]), len(r["b"]))


def test_ratio_bitwise_equal_to_reference_formula(spark):
    rng = random.Random(11)
    rows = [("".join(rng.choice("ab c") for _ in range(rng.randint(1, 40))),
             "".join(rng.choice("ab c") for _ in range(rng.randint(1, 40)))) for _ in range(200)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", token_sort_ratio("a", "b").alias("s")).collect()
    for r in got:
        assert r["s"] == ratio(r["a"], r["b"])


def test_arrow_engine_equals_jvm_engine_and_dp(spark):
    from ledgerlink.functions.similarity import lcs_length_arrow
    rng = random.Random(13)
    lengths = [0, 1, 3, 20, 61, 62, 63, 64, 100, 130]
    rows = [("".join(rng.choice("abcz 19") for _ in range(rng.choice(lengths))),
             "".join(rng.choice("abcz 19") for _ in range(rng.choice(lengths)))) for _ in range(400)]
    rows += [("é ß 名", "ß é 名 x"), (None, "abc")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", lcs_length_arrow("a", "b").alias("arrow"), lcs_length("a", "b").alias("jvm")).collect()
    for r in got:
        want = lcs_dp(r["a"] or "", r["b"] or "")
        assert r["arrow"] == want, (r["a"], r["b"])
        if r["a"] is not None:
            assert r["jvm"] == want
