import datetime as dt

import pytest
from pyspark.sql import functions as F

from chatterscope import fixtures as fx, resources as rs
from chatterscope.operators import summaries as su
from chatterscope.sinks import tables as sk
from chatterscope.sources import posts as ps, rss

D = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 1, 5)


def test_second_append_adds_nothing(spark, tmp_path):
    path, posts = str(tmp_path / "posts"), fx.raw_posts(spark, D)
    empty = spark.createDataFrame([], posts.schema)
    first = sk.append_counted(posts, empty, "raw_posts", [F.col("created_utc")], path)
    again = sk.append_counted(posts.union(posts), spark.read.parquet(path), "raw_posts", [F.col("created_utc")], path)
    assert first == {"attempted": 200, "inserted": 200}
    assert again == {"attempted": 400, "inserted": 0}
    assert spark.read.parquet(path).count() == 200


def test_first_row_wins_in_batch_and_against_the_table(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", 7)], "k string, v int")
    old = spark.createDataFrame([("b", 9)], "k string, v int")
    got = sk.append_new(new, old, ["k"], [F.col("v")])
    assert {tuple(r) for r in got.collect()} == {("a", 1), ("c", 7)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_upsert_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = spark.createDataFrame([("2024-01-01", "s", 1), ("2024-01-02", None, 2)], "d string, subreddit string, total_posts int")
    table = rows.select(F.to_date("d").alias("summary_date"), "subreddit", "total_posts")
    sk.upsert_daily_summary(table, path)
    sk.upsert_daily_summary(table.where("total_posts = 2").withColumn("total_posts", F.lit(5)), path)
    got = {(str(r.summary_date), r.subreddit, r.total_posts) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-01-01", "s", 1), ("2024-01-02", None, 5)}


def test_upsert_keeps_other_rows_of_its_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    day = F.lit("2024-01-01").cast("date")
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "subreddit string, total_posts int").select(day.alias("summary_date"), "*")
    sk.upsert_daily_summary(rows, path)
    sk.upsert_daily_summary(rows.where("subreddit = 'b' or subreddit is null").withColumn("total_posts", F.lit(9)), path)
    assert {(r.subreddit, r.total_posts) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 9), (None, 9)}


def test_contract(spark):
    posts = spark.createDataFrame(
        [("a", "rss", "t", None, AT), ("b" * 21, "rss", None, 3, AT), ("c", None, "t", 1, None)],
        "post_id string, source string, title string, score int, created_utc timestamp_ntz")
    checked = sk.validate_contract(posts, "raw_posts")
    assert [(r.post_id, r.score) for r in sk.valid(checked).collect()] == [("a", 0)]
    bad = {r.post_id[0]: r.violations for r in sk.quarantined(checked).collect()}
    assert sk.quarantined(sk.validate_contract(posts, "raw_posts", lengths=False)).count() == 2
    assert bad == {"b": ["title is null", "post_id is longer than 20"], "c": ["source is null", "created_utc is null"]}


def test_children_go_with_their_posts(spark):
    posts = spark.createDataFrame([("a",), ("b",)], "post_id string")
    child = spark.createDataFrame([("a", 1), ("b", 2), ("x", 3)], "post_id string, v int")
    left, rest = sk.delete_posts_cascade(posts.where("post_id = 'a'"), posts, child)
    assert [r.post_id for r in left.collect()] == ["b"]
    assert sorted(r.v for r in rest.collect()) == [2, 3]
    assert [r.v for r in sk.orphans(child, posts).collect()] == [3]
    assert sk.fk_semi(child, posts).count() == 2


def test_top_term_ties_go_by_name_and_missing_subreddits_match(spark):
    posts = spark.createDataFrame([("a", None, AT), ("b", "s", AT)], "post_id string, subreddit string, created_utc timestamp_ntz")
    scores = spark.createDataFrame([("a", 0.5, "positive"), ("b", -0.5, "negative")], "post_id string, compound double, label string")
    found = spark.createDataFrame([("a", "Beta", 2), ("a", "Alpha", 2), ("b", "Gamma", 1)], "post_id string, entity_text string, mention_count long")
    got = {r.subreddit: r.top_entity for r in su.daily_summary(posts, scores, entities=found).collect()}
    assert got == {None: "Alpha", "s": "Gamma"}


def test_broken_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"post_id": "a", "title": "x", "created_epoch": 0, "body": ""}\n{"post_id": oops\n')
    landed = ps.read_posts(spark, str(tmp_path))
    assert landed.count() == 2
    posts = ps.normalize_post(ps.parsed(landed)).collect()
    assert [(p.post_id, p.author, p.body, p.created_utc) for p in posts] == [("a", "[deleted]", None, dt.datetime(1970, 1, 1))]


def test_listings(spark):
    posts = spark.createDataFrame(
        [(f"p{i}", "technology" if i % 2 else "world", i, AT + dt.timedelta(minutes=10 - i)) for i in range(10)],
        "post_id string, subreddit string, score int, created_utc timestamp_ntz")
    ids = lambda df: [r.post_id for r in df.orderBy("subreddit", "rank").collect()]
    assert ids(ps.select_listing(posts, "new", 2)) == ["p1", "p3", "p0", "p2"]
    assert ids(ps.select_listing(posts, "nonsense", 2)) == ["p1", "p3", "p0", "p2"]
    assert ids(ps.select_listing(posts, "top", 1)) == ["p9", "p8"]
    assert ids(ps.select_listing(posts, "hot", 1)) == ["p9", "p8"]
    assert ids(ps.read_targets(posts, " world ,nowhere", limit=1)) == ["p0"]
    assert {r.subreddit for r in ps.read_targets(posts).collect()} == {"technology"}


def test_address_prefixes_collide_but_keys_do_not(spark):
    row = rss.rss_key(fx.rss_items(spark, "/root/testdata/sf0.01")).agg(
        F.count_distinct("post_id"), F.count_distinct("legacy_key"), F.max(F.length("post_id"))).first()
    assert tuple(row) == (250, 97, 20)


def test_feeds(spark, tmp_path):
    folder = tmp_path / "feed=bbc_world"
    folder.mkdir()
    (folder / "a.xml").write_text("""<rss><channel><title>World</title>
      <item><guid isPermaLink="false">id-1</guid><link>http://x/1</link><title>One</title>
        <pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item>
      <item><link>http://x/2</link><title>Two</title></item>
      <item><title>Three</title></item></channel></rss>""")
    (folder / "b.xml").write_text("<rss><channel><item><title>broken")
    got = rss.read_rss(spark, str(tmp_path), rs.feed_map(spark), AT, use_published=True).collect()
    assert {(r.title, r.subreddit, r.source) for r in got} >= {(t, "world", "rss") for t in ("One", "Two", "Three")}
    assert {r.title: r.created_utc for r in got}["One"] == dt.datetime(2024, 1, 2, 10)
    assert {r.title: r.created_utc for r in got}["Two"] == AT
    assert len({r.post_id for r in got}) == len(got) == 3
    assert [r.created_utc for r in rss.read_rss(spark, str(tmp_path), rs.feed_map(spark), AT).collect()] == [AT] * 3


@pytest.mark.parametrize("date, expected", [
    ("Tue, 02 Jan 2024 10:00:00 GMT", AT.replace(day=2, hour=10)), ("2 Jan 2024 10:00 +0200", AT.replace(day=2, hour=8)),
    ("Tue, 02 Jan 2024 10:00:00 -0530", dt.datetime(2024, 1, 2, 15, 30)), ("02 jan 2024 10:00:00 EST", AT.replace(day=2, hour=15)),
    ("2024-01-02T10:00:00Z", AT.replace(day=2, hour=10)), ("2024-01-02 10:00:00+01:00", AT.replace(day=2, hour=9)),
    ("2024-01-02T10:00", AT.replace(day=2, hour=10)), ("yesterday", None), ("31 Foo 2024 10:00 GMT", None), (None, None), ("", None)])
def test_publication_dates(spark, date, expected):
    assert spark.createDataFrame([(date,)], "pubDate string").select(rss.published_at()).first()[0] == expected


def test_items_of_unknown_feeds_are_kept(spark):
    items = fx.rss_items(spark, D).withColumn("feed", F.lit("new feed"))
    posts = rss.items_to_posts(items, rs.feed_map(spark), AT)
    assert posts.count() == items.count() and {r.subreddit for r in posts.select("subreddit").distinct().collect()} == {"new feed"}


def test_session_zone_changes_nothing(spark):
    from chatterscope.functions import times
    rows = spark.createDataFrame([(0.0, "2024-03-10 02:30:15"), (1704103200.5, "2024-11-03 01:59:59.5")], "e double, t string")
    rows = rows.select("e", F.col("t").cast("timestamp_ntz").alias("t"))
    own = rows.select(times.from_epoch(F.col("e")), times.hour_of(F.col("t")), times.day_of(F.col("t")), times.epoch_of(F.col("t")))
    expected = [
        (dt.datetime(1970, 1, 1), dt.datetime(2024, 3, 10, 2), dt.datetime(2024, 3, 10), 1710037815),
        (dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 11, 3, 1), dt.datetime(2024, 11, 3), 1730599199)]
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [tuple(r) for r in own.collect()] == expected
            posts = ps.normalize_post(fx.landed_posts(spark, D)).join(fx.raw_posts(spark, D).select("post_id", F.col("created_utc").alias("own")), "post_id")
            assert posts.where("created_utc != own - make_dt_interval(0, 0, 0, extract(second from own) - second(own))").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sources_add_up_with_their_duplicates(spark):
    a = spark.createDataFrame([("a", "t", "b")], "post_id string, title string, body string")
    both = ps.union_sources(a, a.drop("body"))
    assert [r.body for r in both.orderBy(F.col("body").desc()).collect()] == ["b", None]
