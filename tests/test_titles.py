"""A post's text is carried once per post, not once per mention."""

import datetime as dt

from hypeline.plans import adapters, models

SF = "/root/testdata/sf0.001"


def outputs(df, kind):
    """Column names that the operators of one kind give, over the optimised plan."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == kind:
            found.append([node.output().apply(i).name() for i in range(node.output().size())])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_summary_joins_and_groups_mentions_without_their_title(spark):
    from hypeline.plans.queries import q_daily_summary
    joins = outputs(q_daily_summary(spark, SF), "Join")
    mentions = [names for names in joins if "matched_player" in names and "created_utc" in names]
    assert mentions and not [names for names in mentions if "title" in names]


def test_post_stats_tells_titles_apart(spark):
    at, day = dt.datetime(2025, 12, 5, 8), dt.date(2025, 12, 5)
    rows = [("Ann Lee", t, 1, 2, at, day, "Other") for t in ("x" * 50_000, "x" * 50_000, "x" * 50_001, "é", "e", "", None)]
    mentions = spark.createDataFrame(rows, "matched_player string, title string, num_comments bigint, score bigint, "
                                           "created_utc timestamp, created_date date, post_type string")
    got = models.post_stats(mentions, "2025-12-01").collect()
    assert [(r.posts_count, r.total_comments, r.total_score) for r in got] == [(5, 7, 14)]
    ids = mentions.withColumn(models.TITLE_ID, models.title_id()).drop("title")
    assert models.post_stats(ids, "2025-12-01").collect() == got


def test_title_ids_are_an_added_column(spark):
    posts = models.stage_posts(adapters.raw_posts(spark, SF))
    games = models.stage_game_logs(adapters.raw_game_logs(spark, SF))
    for unique in (False, True):
        plain = models.player_mentions(posts, games, unique_posts=unique)
        more = models.player_mentions(posts, games, unique_posts=unique, title_ids=True)
        assert more.columns == [*plain.columns, models.TITLE_ID]
        assert plain.count() == more.count() > 0 and plain.exceptAll(more.select(*plain.columns)).count() == 0
