import pytest
from pyspark.sql import functions as F

from chatterscope import fixtures as fx
from chatterscope.functions.times import from_epoch
from chatterscope.sinks.keys import KeyIndex
from chatterscope.sources import posts as ps
from chatterscope.streaming import live, pipeline as pl


def keys(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("k"), F.col("id")).alias("post_id"))


def names(df):
    return sorted(r.post_id for r in df.collect())


def test_known_are_the_keys_of_other_batches(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), buckets=4)
    assert not index.exists(spark) and index.known(keys(spark, 0, 5)).isEmpty()
    index.add(keys(spark, 0, 50).unionByName(keys(spark, 0, 50)), "a")
    index.add(keys(spark, 40, 60), "b")
    index.add(keys(spark, 40, 60), "b")  # a batch that is repeated
    assert index.exists(spark)
    assert names(index.known(keys(spark, 45, 70))) == names(keys(spark, 45, 60))
    assert names(index.known(keys(spark, 45, 70), "b")) == names(keys(spark, 45, 50))
    assert index.maybe_known(keys(spark, 100, 1100)).count() < 20


def test_many_batches_leave_few_files(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), buckets=2, most_files=3)
    for n in range(12):
        index.add(keys(spark, 10 * n, 10 * n + 12), f"b{n}")
        assert len(list((tmp_path / "index").glob("keys-*/*.parquet"))) <= 2 * 4
    again = KeyIndex(str(tmp_path / "index"), buckets=2, most_files=3)
    assert names(again.known(keys(spark, 0, 200))) == names(keys(spark, 0, 122))
    assert names(again.known(keys(spark, 100, 130), "b11")) == names(keys(spark, 100, 112))


def test_a_lost_compaction_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    index = KeyIndex(str(tmp_path / "index"), buckets=2)
    index.add(keys(spark, 0, 20), "a")
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.compact(spark, "a")
    assert index.known(keys(spark, 0, 30)).count() == 20
    index.compact(spark, "z")
    assert index.known(keys(spark, 0, 30), "a").count() == 20


def test_an_append_neither_scans_posts_nor_shuffles_the_index(spark, tmp_path):
    tables = pl.Tables(str(tmp_path / "t"), key_buckets=4)
    landed = fx.landed_posts(spark, "/root/testdata/sf0.001").withColumn("_corrupt_record", F.lit(None).cast("string"))
    posts = ps.normalize_post(ps.parsed(landed))
    assert pl.store_new_posts(posts.where("subreddit = 'en'"), "b0", tables, [F.col("created_utc")]).count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = tables.post_keys(spark).known(posts.select("post_id"), "b1")
        plan = known._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "t/raw_posts" not in plan
    # On the way from the index to the join there is no exchange, and none after it.
    above = plan[: plan.index("Bucketed: true")]
    assert "Exchange" not in above
    assert pl.store_new_posts(posts, "b1", tables, [F.col("created_utc")]).where("subreddit = 'en'").isEmpty()
    assert tables.raw_posts(spark).count() == 200


def test_tables_without_an_index_get_one(spark, tmp_path):
    tables = pl.Tables(str(tmp_path / "t"), key_buckets=2)
    rows = spark.createDataFrame([("a", "2024-01-01", "b0")], "post_id string, dt string, batch string").withColumn("dt", F.to_date("dt"))
    rows.write.partitionBy("dt", "batch").parquet(tables.path("raw_posts"))
    assert names(tables.post_keys(spark).known(spark.createDataFrame([("a",), ("b",)], "post_id string"))) == ["a"]


def test_hours_of_a_stream_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("s", 0.1, "neutral", 10 * 60 + m) for m in (10, 40)], "subreddit string, compound double, label string, m int")
    scored = rows.withColumn("created_utc", from_epoch(F.lit(1_700_006_400) + F.col("m") * 60))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = live.stream_hourly_sentiment(scored, None).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(str(r.hour_bucket), r.total_posts) for r in got] == [("2023-11-15 10:00:00", 2)]
