import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chatterscope import fixtures as fx
from chatterscope.functions.numbers import alert_band, percent, round_half_up, sentiment_label
from chatterscope.functions.times import timestamp
from chatterscope.operators import summaries as su, trends as tr

START = dt.datetime(2024, 1, 1)
SCHEMA = "subreddit string, keyword string, hour_bucket timestamp_ntz, frequency long"


def series(spark, values, gaps=None):
    hours = gaps or range(len(values))
    return spark.createDataFrame(
        [("s", "k", START + dt.timedelta(hours=h), v) for h, v in zip(hours, values)], SCHEMA)


def test_frame_edge(spark):
    values = [1000] + [1] * 168 + [5]
    got = tr.trending_keywords(series(spark, values)).orderBy("hour_bucket").collect()
    assert got[0].rolling_avg_7d is None and got[0].spike_ratio is None and not got[0].is_trending
    assert got[168].rolling_avg_7d == round(1167 / 168, 2)
    assert (got[169].rolling_avg_7d, got[169].spike_ratio, got[169].is_trending) == (1.0, 5.0, True)


def test_history_of_zeros(spark):
    got = tr.trending_keywords(series(spark, [0, 0, 3, 0])).orderBy("hour_bucket").collect()
    assert [(r.spike_ratio, r.is_trending) for r in got] == [(None, False), (None, False), (None, True), (0.0, False)]


def test_twice_the_mean_is_not_yet_trending(spark):
    got = tr.trending_keywords(series(spark, [2, 4, 7])).orderBy("hour_bucket").collect()
    assert [r.is_trending for r in got] == [False, False, True]


def test_running_totals_equal_the_sliding_frame(spark):
    rng = random.Random(1)
    hours = sorted(rng.sample(range(3000), 600))
    trends = series(spark, [rng.randint(0, 9) for _ in hours], hours)
    frame = "OVER (PARTITION BY subreddit, keyword ORDER BY hour_bucket ROWS BETWEEN 168 PRECEDING AND "
    both = tr.rolling_avg_7d(trends).withColumn("plain", F.expr(f"avg(frequency) {frame} 1 PRECEDING)"))
    assert both.where("not (rolling_avg_7d <=> plain)").count() == 0
    totals = tr.cumulative_total(trends).withColumn("plain", F.expr(f"sum(frequency) {frame} CURRENT ROW)"))
    assert totals.where("not (cumulative_total <=> plain)").count() == 0


def test_strict_time_counts_hours(spark):
    trends = series(spark, [1, 1, 9], [0, 200, 300])
    rows = tr.trending_keywords(trends, strict_time=True).orderBy("hour_bucket").collect()
    assert [r.rolling_avg_7d for r in rows] == [None, None, 1.0]
    assert [r.rolling_avg_7d for r in tr.trending_keywords(trends).orderBy("hour_bucket").collect()] == [None, 1.0, 1.0]


@pytest.mark.parametrize("scale, flagged, strict", [("sf0.001", 1, 1), ("sf0.01", 342, 376)])
def test_known_counts(spark, scale, flagged, strict):
    trends = fx.keyword_trends(spark, f"/root/testdata/{scale}")
    assert tr.trending_keywords(trends).where("is_trending").count() == flagged
    assert tr.trending_keywords(trends, strict_time=True).where("is_trending").count() == strict


def test_unrated_rows_come_first_in_the_timeline(spark):
    trends = series(spark, [0, 3], [0, 0]).withColumn("keyword", F.concat("keyword", F.col("frequency")))
    rows = tr.keyword_timeline(tr.trending_keywords(trends.union(series(spark, [1, 1], [-1, 0]))), START)
    assert [r.spike_ratio for r in rows.collect()][:1] == [None]


def test_alerts_take_one_shuffle_after_the_scan(spark, tmp_path):
    path = str(tmp_path / "kt")
    series(spark, [1, 5]).write.parquet(path)
    alerts = tr.trend_alerts(tr.trending_keywords(spark.read.parquet(path)), "2024-01-02 00:00:00")
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_recent_filter_reaches_the_scan(spark):
    posts, scores = fx.wide_posts(spark, "/root/testdata/sf0.001"), fx.sentiment(spark, "/root/testdata/sf0.001")
    line = su.sentiment_line(posts, scores, "2024-01-30 00:00:00")
    plan = line._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-23T00:00)" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_shares_sum_to_hundred(spark):
    d = "/root/testdata/sf0.01"
    rows = su.daily_summary(fx.wide_posts(spark, d), fx.sentiment(spark, d))
    off = F.abs(F.col("positive_pct") + F.col("negative_pct") + F.col("neutral_pct") - 100)
    assert rows.where(off > 0.2).count() == 0 and rows.count() == 150


@pytest.mark.parametrize("value, digits, expected", [(1.005, 2, 1.01), (-2.5, 0, -3.0), (0.125, 2, 0.13)])
def test_rounding(spark, value, digits, expected):
    assert spark.range(1).select(round_half_up(F.lit(value), digits)).first()[0] == expected


def test_bands_and_labels(spark):
    rows = spark.createDataFrame([(v,) for v in (5.1, 5.0, 3.0, 2.99, 2.0, 1.9)], "v double")
    assert [r[0] for r in rows.select(alert_band(F.col("v"))).collect()] == [
        "red", "orange", "orange", "yellow", "yellow", None]
    rows = spark.createDataFrame([(v,) for v in (0.05, 0.0499, -0.05, -0.0499)], "v double")
    assert [r[0] for r in rows.select(sentiment_label(F.col("v"))).collect()] == [
        "positive", "neutral", "negative", "neutral"]


def test_timestamps_are_taken_as_utc(spark):
    aware = dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    row = spark.range(1).select(timestamp(aware), timestamp("2024-01-01 00:00:00"), timestamp(START)).first()
    assert set(row) == {START}
