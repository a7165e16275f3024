from pyspark.sql import functions as F

from ledgerlink.operators import linkage as L

S1 = "corporate_name_s1 string, address string, activity_places string, top_suppliers string"
S2 = "corporate_name_s2 string, main_customers string, revenue double, profit double"


def sources(spark):
    s1 = spark.createDataFrame([
        ("Acme Corp", "1 Main Street", "NY", "S1"),
        ("ACME, Inc.", "2 Main Street", "CA", "S2"),          # same clean name as the row above
        ("Globex Ltd", "3 Elm Road", "TX", "S3"),
        ("Initech LLC", "4 Oak Avenue", "WA", None),
        ("Inc", "5 Pine Drive", "", ""),                       # suffix only: blank clean name
        ("Umbrella Corporation", "6 Birch Boulevard", None, "S4"),
        ("abcdef x", "7", None, None),                         # equal scores against two list-2 names
    ], S1)
    s2 = spark.createDataFrame([
        ("ACME", "Retail", 10.0, 1.0),
        ("Globexx", "Retail|Auto", 20.0, 2.0),
        ("Initech", None, 30.0, 3.0),
        ("Inc.", "", 40.0, 4.0),
        ("Soylent", "Food", None, None),
        ("abcdef z", None, 1.0, 1.0),
        ("abcdef y", None, 2.0, 2.0),
    ], S2)
    return s1, s2


def test_resolution_kinds(spark):
    s1, s2 = sources(spark)
    ent = {(r["clean_name_s1"], r["clean_name_s2"]): r for r in L.resolve_entities(s1, s2, 85.0).collect()}
    acme = ent[("acme", "acme")]
    assert acme["match_type"] == "exact_name" and acme["n_rows_s1"] == 2 and acme["n_rows_s2"] == 1
    assert acme["match_confidence"] == 100.0
    assert ent[("initech", "initech")]["match_type"] == "exact_name"
    glob = ent[("globex", "globexx")]
    assert glob["match_type"] == "fuzzy_name"
    assert glob["match_confidence"] == (1.0 - 1 / 13) * 100.0
    # score tie: the smaller list-2 name wins
    assert ent[("abcdef x", "abcdef y")]["match_type"] == "fuzzy_name"
    assert ent[(None, "abcdef z")]["match_type"] == "source2_only"
    assert ent[("umbrella", None)]["match_type"] == "source1_only"
    assert ent[(None, "soylent")]["match_type"] == "source2_only"
    # blank names never link; each is its own entity keyed by its row id
    assert ent[("", None)]["match_type"] == "source1_only"
    assert ent[(None, "")]["match_type"] == "source2_only"
    assert ent[("", None)]["corporate_id"] == ent[("", None)]["row_id_s1"]


def test_invariants(spark):
    s1, s2 = sources(spark)
    ent = L.resolve_entities(s1, s2, 85.0)
    assert ent.count() == ent.select("corporate_id").distinct().count()
    links = L.link_rows(s1, s2, ent)
    # every input row belongs to an entity; list-1 rows to exactly one
    assert links.filter(F.col("source") == "source1").select("row_id").distinct().count() == s1.count()
    assert links.filter(F.col("source") == "source1").count() == s1.count()
    assert links.filter(F.col("source") == "source2").select("row_id").distinct().count() == s2.count()
    exact = ent.filter("match_type = 'exact_name'").select("clean_name_s1")
    fuzzy = ent.filter("match_type = 'fuzzy_name'").select("clean_name_s1")
    assert exact.intersect(fuzzy).count() == 0


def test_identical_rows_collapse_and_partitioning_does_not_matter(spark):
    s1, s2 = sources(spark)
    s1x = s1.unionByName(s1).unionByName(s1)
    a = L.resolve_entities(s1x.repartition(7), s2.repartition(3), 85.0).drop("n_rows_s1")
    b = L.resolve_entities(s1x.coalesce(1), s2.coalesce(1), 85.0).drop("n_rows_s1")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    blank = L.resolve_entities(s1x, s2, 85.0).filter("clean_name_s1 = ''").collect()
    assert len(blank) == 1 and blank[0]["n_rows_s1"] == 3


def test_length_window_never_drops_a_passing_pair(spark):
    # names of very different lengths in one block cannot pass; near lengths can
    s1 = spark.createDataFrame([("abcdefghij", None, None, None)], S1)
    s2 = spark.createDataFrame([(n, None, 1.0, 1.0) for n in ["abcdefghijk", "abcdefghijklmnopqrstu", "abcdefgh"]], S2)
    scored = L.score_pairs(L.candidate_pairs(L.named(L.collapse_side(L.prepare_source1(s1), "s1"), "s1"),
                                             L.named(L.collapse_side(L.prepare_source2(s2), "s2"), "s2"), 85.0))
    got = {r["clean_name_s2"]: r["name_score"] for r in scored.collect()}
    assert "abcdefghijklmnopqrstu" not in got          # 10 vs 21 chars: at most 64.5
    assert got["abcdefghijk"] >= 85 and got["abcdefgh"] >= 85


def test_block_statistics(spark):
    s1, s2 = sources(spark)
    stats = {r["block"]: r for r in L.block_statistics(s1, s2).collect()}
    assert stats["abcdef"]["names_s1"] == 1 and stats["abcdef"]["names_s2"] == 2
    assert stats["abcdef"]["candidate_pairs"] == 2
    assert stats["umbrel"]["names_s2"] == 0


def test_match_blank_restores_blank_links(spark):
    s1, s2 = sources(spark)
    ent = L.resolve_entities(s1, s2, 85.0, match_blank=True)
    blank = ent.filter("clean_name_s1 = '' OR clean_name_s2 = ''").collect()
    assert len(blank) == 1 and blank[0]["match_type"] == "exact_name"
    import hashlib
    assert blank[0]["corporate_id"] == hashlib.sha256(b"").hexdigest()
    links = L.link_rows(s1, s2, ent, match_blank=True)
    assert links.filter("source = 'source1'").count() == s1.count()


def test_repeated_names_keep_what_every_row_says(spark):
    s1 = spark.createDataFrame([("Tarn Mills", " ", "Oslo", "S2| S1"), ("TARN, mills Ltd", "2 Fell Road", None, "S3|S1"), ("Co. Tarn Mills", "1 Fell Road", None, None)], S1)
    s2 = spark.createDataFrame([("Tarn Mills", "B", 500.0, 9.0), ("tarn mills", "A|B", 900.0, None), ("Tarn Mills Corp", None, None, 70.0),
                                ("Tarn (Mills)", None, float("nan"), 1.0)], S2)
    r = L.resolve_entities(s1, s2, 85.0).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["n_rows_s1"], r["n_rows_s2"], r["corporate_name_s1"], r["address"], r["clean_address_s1"]) == (3, 4, "Co. Tarn Mills", "1 Fell Road", "1 fell rd")
    assert (r["activity_places"], r["top_suppliers"], r["main_customers"], r["revenue"], r["profit"]) == ("Oslo", "S1|S2|S3", "A|B", 900.0, None)
    rows = L.link_rows(s1, s2, L.resolve_entities(s1, s2, 85.0)).collect()
    assert sorted((x["address"] or "") for x in rows if x["source"] == "source1") == [" ", "1 Fell Road", "2 Fell Road"]


def test_row_ids_tell_money_values_apart(spark):
    values = [(None, None), (1e33, None), (float("nan"), None), (float("inf"), None), (0.1234567, None), (0.1234568, None), (None, 1e33), (0.0, None)]
    df = spark.createDataFrame([("x", None, a, b) for a, b in values], S2)
    assert L.prepare_source2(df).select("row_id_s2").distinct().count() == len(values)


def test_any_threshold_is_accepted(spark):
    s1, s2 = sources(spark)
    kinds = {t: L.resolve_entities(s1, s2, t).groupBy("match_type").count().collect() for t in (0.0, -5.0, 100.0, 150.0)}
    assert sorted(map(tuple, kinds[0.0])) == sorted(map(tuple, kinds[-5.0]))
    assert "fuzzy_name" not in {r["match_type"] for r in kinds[150.0]}


def test_one_to_one(spark):
    s1 = spark.createDataFrame([("abcdefgh1", None, None, None), ("abcdefgh12", None, None, None)], S1)
    s2 = spark.createDataFrame([("abcdefgh", None, 1.0, 1.0)], S2)
    default = {r["clean_name_s1"]: r["match_type"] for r in L.resolve_entities(s1, s2, 85.0).collect() if r["clean_name_s1"]}
    assert default == {"abcdefgh1": "fuzzy_name", "abcdefgh12": "fuzzy_name"}
    strict = {r["clean_name_s1"]: r["match_type"] for r in L.resolve_entities(s1, s2, 85.0, one_to_one=True).collect()
              if r["clean_name_s1"]}
    assert strict == {"abcdefgh1": "fuzzy_name", "abcdefgh12": "source1_only"}


def test_salting_hot_blocks_changes_nothing(spark):
    from ledgerlink.sources import fixtures
    s1, s2 = fixtures.company_sources(spark, "/root/testdata/sf0.01")
    plain = L.resolve_entities(s1, s2, 85.0, pairs_per_task=None)
    salted = L.resolve_entities(s1, s2, 85.0, pairs_per_task=1)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    # hand-made hot block: 30 x 30 near-identical names in one (block, length) key
    h1 = spark.createDataFrame([(f"hotblock {i:02d}", None, None, None) for i in range(30)], S1)
    h2 = spark.createDataFrame([(f"hotblock {i:02d}x", None, 1.0, 1.0) for i in range(30)], S2)
    a = L.resolve_entities(h1, h2, 85.0, pairs_per_task=None).collect()
    b = L.resolve_entities(h1, h2, 85.0, pairs_per_task=50).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    # each pair is formed exactly once, and the hot key is spread over a 5 x 5 grid
    u1 = L.named(L.collapse_side(L.prepare_source1(h1), "s1"), "s1")
    u2 = L.named(L.collapse_side(L.prepare_source2(h2), "s2"), "s2")
    pairs = L.candidate_pairs(u1, u2, 85.0, pairs_per_task=50)
    assert pairs.count() == pairs.select("clean_name_s1", "clean_name_s2").distinct().count() == 900
    left, right, keys = L._salt_grid(
        L._fuzzy_keys(u1, "s1", 6).withColumn("_band", F.lit(0)),
        L._fuzzy_keys(u2, "s2", 6).withColumn("_band", F.lit(0)), ["block", "_band"], 50)
    cells = left.join(right, keys).groupBy("_c1", "_c2").count().collect()
    assert len(cells) == 25 and max(r["count"] for r in cells) <= 2 * 50


def test_planted_truth_precision_recall(spark):
    """The part key is the last token of every derived name: a link is right when both
    clean names end in the same key.  Keys with % 10 in (4, 5) are the planted pairs."""
    from ledgerlink.sources import fixtures
    s1, s2 = fixtures.company_sources(spark, "/root/testdata/sf0.01")
    ent = L.resolve_entities(s1, s2, 85.0)
    links = ent.filter(F.col("match_type").isin("exact_name", "fuzzy_name"))
    key1 = F.element_at(F.split("clean_name_s1", " "), -1)
    key2 = F.element_at(F.split("clean_name_s2", " "), -1)
    right = links.filter(key1 == key2)
    names = L.prepare_source1(s1).filter("clean_name_s1 <> ''").select("clean_name_s1").distinct()
    planted = names.filter(key1.cast("int") % 10 >= 4).count()
    n_links, n_right = links.count(), right.count()
    assert planted == 400
    assert n_right == 400                     # recall 1.0
    assert n_right / n_links >= 0.99          # precision: a couple of near-identical false pairs
    assert right.filter("match_type = 'exact_name'").count() == 200


def test_empty_side_and_null_names(spark):
    s1, s2 = sources(spark)
    empty2 = s2.filter(F.lit(False))
    ent = L.resolve_entities(s1, empty2, 85.0)
    assert {r["match_type"] for r in ent.collect()} == {"source1_only"}
    assert ent.count() == 6                      # 7 rows, two spell the same name
    nulls = spark.createDataFrame([(None, None, None, None), (None, None, None, None)], S1)
    ent = L.resolve_entities(nulls, empty2, 85.0).collect()
    assert len(ent) == 1 and ent[0]["n_rows_s1"] == 2 and ent[0]["match_type"] == "source1_only"
    from ledgerlink.operators.reporting import reconciliation_report
    from ledgerlink.operators.harmonize import harmonize_records
    r = reconciliation_report(nulls, empty2, harmonize_records(L.resolve_entities(nulls, empty2))).first()
    assert (r["final_rows"], r["duplicates_removed"], r["match_rate_pct"]) == (1, 1, 0.0)


def test_skewed_inputs_derived_from_the_tables(spark):
    """A name carried by half of all list-1 rows, and a block shared by every name."""
    from ledgerlink.sources import fixtures
    s1, s2 = fixtures.company_sources(spark, "/root/testdata/sf0.001")
    n = s1.count()
    hot_copies = s1.unionByName(s1.withColumn("corporate_name_s1", F.lit("Hot Copy Holdings Inc")))
    ent = L.resolve_entities(hot_copies, s2, 85.0)
    hot = ent.filter("clean_name_s1 = 'hot copy holdings'").collect()
    assert len(hot) == 1 and hot[0]["n_rows_s1"] == n
    assert ent.count() == L.resolve_entities(s1, s2, 85.0).count() + 1
    # one hot block: prefix every name on both sides with the same six characters
    b1 = s1.withColumn("corporate_name_s1", F.concat(F.lit("zzhot "), "corporate_name_s1"))
    b2 = s2.withColumn("corporate_name_s2", F.concat(F.lit("zzhot "), "corporate_name_s2"))
    plain = L.resolve_entities(b1, b2, 85.0, pairs_per_task=None)
    gridded = L.resolve_entities(b1, b2, 85.0, pairs_per_task=200)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, gridded.collect()))
    assert {r["block"] for r in L.block_statistics(b1, b2).collect()} == {"zzhot ", "zzhot"}  # the latter: names of a suffix alone


def test_link_rows_salts_hot_names(spark):
    s1, s2 = sources(spark)
    copies = s1.filter("corporate_name_s1 = 'Acme Corp'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50))))
    hot = s1.unionByName(copies.drop("n"))
    ent = L.resolve_entities(hot, s2, 85.0)
    plain = L.link_rows(hot, s2, ent, rows_per_task=10**9)
    salted = L.link_rows(hot, s2, ent, rows_per_task=5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    assert salted.filter("source = 'source1'").count() == hot.count()


def test_a_hot_name_with_differing_lists_is_reduced_by_item(spark):
    from itertools import combinations
    places = [f"P{i:02d}" for i in range(12)]
    lists = ["|".join(c) for c in combinations(places, 4)]  # 495 different lists of 12 items
    s1 = spark.createDataFrame([("Hot Inc", f"{i} Road", x, f"S{i % 7}| S{i % 5} ") for i, x in enumerate(lists)]
                               + [("Hot", None, None, None), ("Cold", "1 Way", None, ""), ("Inc", "x", "B|A|B", None)], S1)
    s2 = spark.createDataFrame([("Hot", x, float(i), None) for i, x in enumerate(lists)] + [("Cold", None, None, 1.0)], S2)
    g1 = L.collapse_side(L.prepare_source1(s1.repartition(4)), "s1")
    g2 = L.collapse_side(L.prepare_source2(s2.repartition(4)), "s2")
    one = {r["clean_name_s1"]: r for r in g1.collect()}
    hot = one["hot"]
    assert hot["n_rows_s1"] == 496 and hot["activity_places"] == "|".join(places) and hot["top_suppliers"] == "|".join(f"S{i}" for i in range(7))
    assert one["cold"]["activity_places"] is None and one["cold"]["top_suppliers"] == ""
    assert one[""]["activity_places"] == "A|B" and one[""]["top_suppliers"] is None
    two = {r["clean_name_s2"]: r for r in g2.collect()}
    assert (two["hot"]["n_rows_s2"], two["hot"]["main_customers"], two["hot"]["revenue"]) == (495, "|".join(places), 494.0)
    assert two["cold"]["main_customers"] is None and two["cold"]["profit"] == 1.0
    # nothing gathers whole lists: the items are what the first aggregate is keyed by, and single items are collected
    for g in (g1, g2):
        plan = g._jdf.queryExecution().optimizedPlan().toString()
        first = [x for x in plan.splitlines() if "Aggregate [" in x][-1]
        assert "AS _item" in first and "collect_" not in first and "collect_set" not in plan, first


def test_long_lists_of_a_name_are_collapsed_item_by_item_alike(spark):
    rows = [("Acme", f"{i} Road", f"p{i % 7}| q ||p{i % 3}", None if i % 2 else f"s{i}") for i in range(40)] + [
        ("Bolt", None, "", None), ("bolt inc", " ", None, None), ("Inc", "a", "x", "y"), ("Inc", "a", "x", "y"), ("Ltd", "b", None, None)]
    s1 = L.prepare_source1(spark.createDataFrame(rows, S1))
    figures = [("Acme", f"c{i % 5}|d", float(i % 9) if i % 4 else float("nan"), float(i)) for i in range(40)] + [("Inc", None, None, None), ("Co", "x", 1.0, None)]
    s2 = L.prepare_source2(spark.createDataFrame(figures, S2))
    for side, sfx in ((s1, "s1"), (s2, "s2")):
        short, mixed, long = (sorted(map(repr, L.collapse_side(side, sfx, hot_chars=k).collect())) for k in (1 << 30, 1000, 0))
        assert short == mixed == long
    acme = L.collapse_side(s1, "s1").filter("clean_name_s1 = 'acme'").first()
    assert acme["n_rows_s1"] == 40 and acme["activity_places"] == "p0|p1|p2|p3|p4|p5|p6|q"
    # rows of names without long lists meet without being taken apart
    plan = L.collapse_side(s1, "s1")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
