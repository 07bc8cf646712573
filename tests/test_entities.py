from hypeline.operators import match_entities, roster


def _match(spark, titles, names, normalize=False):
    docs = spark.createDataFrame(list(enumerate(titles)), "post_id long, title string")
    r = roster(spark.createDataFrame([(n,) for n in names], "player_name string"), "player_name",
               normalize=normalize)
    return sorted((x.post_id, x.matched_player) for x in match_entities(docs, r, "post_id", "title").collect())


def test_repeat_mention_counts_once(spark):  # J-1
    assert _match(spark, ["LeBron James and lebron james!"], ["LeBron James"]) == [(0, "LeBron James")]


def test_two_players_two_rows(spark):  # J-2
    got = _match(spark, ["LeBron James passes to Anthony Davis"], ["LeBron James", "Anthony Davis"])
    assert got == [(0, "Anthony Davis"), (0, "LeBron James")]


def test_punctuated_roster_needs_normalize(spark):  # J-3
    assert _match(spark, ["De'Aaron Fox scores"], ["De'Aaron Fox"]) == []
    assert _match(spark, ["De'Aaron Fox scores"], ["De'Aaron Fox"], normalize=True) == [(0, "De'Aaron Fox")]


def test_one_and_four_word_names_never_match(spark):  # J-4
    assert _match(spark, ["Nene and Karl Anthony Towns Junior"], ["Nene", "Karl Anthony Towns Junior"]) == []


def test_three_word_name_and_hyphen(spark):
    got = _match(spark, ["Karl-Anthony Towns: Gary Payton II wins"], ["Karl-Anthony Towns", "Gary Payton II"])
    assert got == [(0, "Gary Payton II"), (0, "Karl-Anthony Towns")]


def test_roster_case_variants_are_two_players(spark):
    assert _match(spark, ["lebron james"], ["LeBron James", "Lebron James"]) == [
        (0, "LeBron James"), (0, "Lebron James")]


def test_shuffle_path_with_length_pruning_equals_broadcast_path(spark):
    from hypeline.plans import adapters, models
    d = "/root/testdata/sf0.01"
    gl = models.stage_game_logs(adapters.raw_game_logs(spark, d))
    posts = adapters.raw_posts(spark, d).select("post_id", "title")
    names = roster(gl, "player_name")
    a = match_entities(posts, names, "post_id", "title")
    b = match_entities(posts, names, "post_id", "title", broadcast_max_rows=1)
    rows = sorted(a.collect())
    assert len(rows) > 50 and rows == sorted(b.collect())


def test_names_of_any_length_match_on_both_paths(spark):
    titles = ["Nene and Karl Anthony Towns Junior the third", "nene", "", None, "Karl Anthony"]
    names = ["Nene", "Karl Anthony Towns Junior", "Karl Anthony", "Absent Name", None, "Nene"]
    docs = spark.createDataFrame(list(enumerate(titles)), "post_id long, title string")
    r = roster(spark.createDataFrame([(n,) for n in names], "player_name string"), "player_name")
    want = [(0, "Karl Anthony"), (0, "Karl Anthony Towns Junior"), (0, "Nene"), (1, "Nene"), (4, "Karl Anthony")]
    for bound in (0, 1000):
        got = match_entities(docs, r, "post_id", "title", broadcast_max_rows=bound, any_length=True)
        assert sorted(tuple(x) for x in got.collect()) == want


def test_empty_roster_matches_nothing(spark):
    docs = spark.createDataFrame([(1, "LeBron James")], "post_id long, title string")
    r = roster(spark.createDataFrame([], "player_name string"), "player_name")
    for bound in (0, 1000):
        for any_length in (False, True):
            assert match_entities(docs, r, "post_id", "title", broadcast_max_rows=bound,
                                  any_length=any_length).count() == 0


def test_bitmap_keeps_every_member_and_drops_nine_of_ten_others(spark):
    from hypeline.operators.membership import filter_words, may_contain, membership_words
    keys = spark.range(20_000).selectExpr("concat('name ', id) AS k").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    probes = spark.range(200_000).selectExpr("id", "concat('name ', id) AS k").union(spark.sql("SELECT -1L, NULL"))
    n = filter_words(20_001)
    words = membership_words(keys, "k", n)
    assert words.count() <= n
    left = may_contain(probes, "k", words, n)
    assert left.columns == ["id", "k"]
    assert left.where("id BETWEEN 0 AND 19999").count() == 20_000
    assert left.where("id >= 20000").count() < 0.1 * 180_000
    assert left.where("k IS NULL").count() == 0


def test_full_bitmap_still_keeps_every_member(spark):
    from hypeline.operators.membership import may_contain, membership_words
    keys = spark.range(5_000).selectExpr("CAST(id AS STRING) AS k")
    assert may_contain(keys, "k", membership_words(keys, "k", 2), 2).count() == 5_000


def test_ngrams_that_reach_the_shuffle_fall_by_nine_tenths(spark):
    from hypeline.functions.text import clean_title, ngrams, tokenize
    from hypeline.operators.entities import in_roster
    from hypeline.plans import adapters, queries
    from pyspark.sql import functions as F
    d = "/root/testdata/sf0.001"
    names = roster(queries.passage_names(spark, d), "player_name")
    posts = adapters.raw_posts(spark, d)
    grams = posts.select(F.explode(ngrams(tokenize(F.lower(clean_title("title"))), 2, 5)).alias("match_name"))
    kept = in_roster(grams, names)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert kept.count() < 0.1 * grams.count()
    exact = grams.join(names, "match_name", "left_semi").count()
    assert kept.join(names, "match_name", "left_semi").count() == exact
