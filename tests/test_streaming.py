import pytest
from pyspark.sql import functions as F

from chatterscope import fixtures as fx, resources as rs
from chatterscope.operators import keywords as kw, sentiment as se, summaries as su
from chatterscope.plans import queries
from chatterscope.sources import posts as ps
from chatterscope.streaming import live, pipeline as pl

D = "/root/testdata/sf0.001"
TABLES = ("raw_posts", "sentiment_scores", "extracted_entities", "keyword_trends", "daily_summary")


@pytest.fixture(scope="module")
def landed(spark):
    return fx.landed_posts(spark, D).withColumn("_corrupt_record", F.lit(None).cast("string"))


def contents(spark, tables):
    frames = {t: getattr(tables, t)(spark) for t in TABLES}
    return {t: sorted(map(str, df.drop("batch").collect())) for t, df in frames.items()}


def test_batches_in_any_order_and_again_end_in_the_same_tables(spark, landed, tmp_path, monkeypatch):
    sides = pl.SideTables.shipped(spark)
    once, parts = pl.Tables(str(tmp_path / "once")), pl.Tables(str(tmp_path / "parts"))
    pl.run_batch(landed, "b0", once, sides)

    late = F.col("created_epoch") < landed.agg(F.avg("created_epoch")).first()[0]
    newer, older = landed.where(~late), landed.where(late)
    pl.run_batch(newer, "b0", parts, sides)
    with monkeypatch.context() as broken:
        def crash(*_, **__):
            raise RuntimeError("lost")
        broken.setattr(pl, "keyword_trends", crash)
        with pytest.raises(RuntimeError):
            pl.run_batch(older.union(newer), "b1", parts, sides)
    assert parts.raw_posts(spark).count() == 200
    pl.run_batch(older.union(newer), "b1", parts, sides)
    assert contents(spark, parts) == contents(spark, once)

    posts = once.raw_posts(spark)
    assert posts.count() == 200
    expected = kw.keyword_trends(fx.raw_posts(spark, D))
    assert once.keyword_trends(spark).drop("dt").exceptAll(expected.select(once.keyword_trends(spark).drop("dt").columns)).count() == 0
    scores = se.lexicon_sentiment(posts, rs.lexicon(spark), rs.modifiers(spark))
    stored = once.sentiment_scores(spark).select(scores.columns)
    assert stored.exceptAll(scores).count() == 0 == scores.exceptAll(stored).count()


def test_empty_batch_writes_nothing(spark, landed, tmp_path):
    pl.run_batch(landed.limit(0), "b0", pl.Tables(str(tmp_path / "t")), pl.SideTables.shipped(spark))
    assert not (tmp_path / "t").exists()


def test_hourly_stream_equals_batch_and_reports_late_rows(spark, tmp_path):
    posts, scores = fx.wide_posts(spark, D), fx.sentiment(spark, D)
    joined = su.posts_join_sentiment(posts, scores).select("post_id", "subreddit", "created_utc", "compound", "label")
    # Rows count as late by the watermark of the batch before, so the late file comes third.
    for i, part in enumerate((
        "created_utc >= '2024-01-02' and created_utc < '2024-01-29'",
        "created_utc >= '2024-01-29'", "created_utc < '2024-01-02'",
    )):
        joined.where(part).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = (spark.readStream.schema(joined.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")))
    out = str(tmp_path / "out")
    run = (live.stream_hourly_sentiment(stream).writeStream.option("path", out)
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    run.awaitTermination()
    dropped = sum(live.dropped_late(p) for p in run.recentProgress)
    closed = spark.read.parquet(out)
    expected = live.stream_hourly_sentiment(joined, None)
    assert closed.count() > 0 and closed.where("hour_bucket >= '2024-01-02'").exceptAll(expected).count() == 0
    assert dropped > 0


def test_stream_dedup(spark, tmp_path):
    path = str(tmp_path / "in")
    fx.landed_posts(spark, D).coalesce(1).write.json(path)
    fx.landed_posts(spark, D).coalesce(1).write.mode("append").json(path)
    posts = ps.normalize_post(ps.parsed(ps.stream_posts(spark, path, files_per_batch=1)))
    run = (live.stream_dedup(posts, "60 days").writeStream.option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    run.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def _files(folder):
    return {f.relative_to(folder).as_posix(): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_a_late_hour_rewrites_that_hour_alone(spark, tmp_path):
    """Only the hour of the late posts gets new keyword files, and its rows are as if all had come at once."""
    tables, sides = pl.Tables(str(tmp_path / "t")), pl.SideTables.shipped(spark)
    rows = [(f"p{h}-{k}", "web", "s", f"ferry harbour number{k} word{h}", None, None, None, 1, 0, h * 3600.0 + k, None)
            for h in (1, 2, 3, 26) for k in range(4)]
    landed = spark.createDataFrame(rows, ps.LANDED_POST)
    late = "created_epoch >= 7202 and created_epoch < 10800"
    pl.run_batch(landed.where(f"not ({late})"), "b0", tables, sides)
    before = _files(tmp_path / "t" / "keyword_trends")
    counts = _files(tmp_path / "t" / "word_counts")
    pl.run_batch(landed.where(late), "b1", tables, sides)
    after = _files(tmp_path / "t" / "keyword_trends")
    own = "dt=1970-01-01/hr=2/"
    assert len(before) == 4 and {f: t for f, t in after.items() if not f.startswith(own)} == {
        f: t for f, t in before.items() if not f.startswith(own)}
    assert not {f for f in after if f.startswith(own)} & set(before)
    assert {f: t for f, t in _files(tmp_path / "t" / "word_counts").items() if "batch=b1" not in f} == counts
    expected = kw.keyword_trends(ps.normalize_post(ps.parsed(landed)))
    got = tables.keyword_trends(spark).drop("dt").select(expected.columns)
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 0
    # Words that were counted before come from the stored counts, not from texts.
    totals = kw.merged_counts(tables.word_counts(spark).where("hour(hour_bucket) = 2"))
    assert {(r.term, r["count"], r.df) for r in totals.collect()} >= {("", 4, 4), ("ferry", 4, 4)}


def test_landed_files_are_no_fixed_number(spark, monkeypatch):
    """Posts land in as many files as their join has partitions, and the hourly job still takes them in two batches."""
    named = []
    monkeypatch.setattr(pl, "run_batch", lambda landed, name, *_: named.append((name, landed.count())))
    monkeypatch.setattr(pl.Tables, "daily_summary", lambda *_: None)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = queries._land(spark, D, "landed")
        queries.hourly_pipeline(spark, D)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    posts = ps.read_posts(spark, path)
    assert len(posts.inputFiles()) > 4 and posts.select("post_id").distinct().count() == 200 == posts.count()
    assert len(named) == 2 and sum(n for _, n in named) == 200


def _small_tables(spark, folder, times):
    """Documents of a few words and one event for each, at the given times."""
    texts = [(i, f"Ferry{i}\nharbour lights number{i} harbour", "en") for i in range(len(times))]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    events = [(i, at, i, 1.0, '{"k": 1}') for i, at in enumerate(times)]
    spark.createDataFrame(events, "event_id long, ts string, user_id long, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{folder}/events.parquet")
    return folder


def test_late_posts_arrive_day_by_day_backwards(spark, tmp_path, monkeypatch):
    """One run for each day, the latest day first and posts without a time last, and no post is left out."""
    times = ["2024-01-01 23:59:59.9", None, "2024-01-05 12:00:00", "2024-01-01 00:00:00", "2024-01-05 00:00:00", "2024-01-05 12:30:00"]
    folder, arrived = _small_tables(spark, str(tmp_path / "given"), times), []
    run = pl.run_batch

    def watched(landed, name, *rest):
        day = F.to_date(F.timestamp_seconds("created_epoch")).cast("string")
        arrived.append(sorted((r.day, r.post_id) for r in landed.select(day.alias("day"), "post_id").collect()))
        run(landed, name, *rest)

    monkeypatch.setattr(pl, "run_batch", watched)
    got = queries.late_posts(spark, folder)
    assert arrived == [
        [("2024-01-05", "d2"), ("2024-01-05", "d4"), ("2024-01-05", "d5")], [("2024-01-01", "d0"), ("2024-01-01", "d3")], [(None, "d1")],
    ]
    expected = kw.keyword_trends(fx.raw_posts(spark, folder)).select(got.columns)
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 0
