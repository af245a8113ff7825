"""Keyword trend views over ``keyword_trends`` rows (one row per subreddit, keyword and hour)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatterscope.constants import ROLLING_ROWS, SPIKE_FACTOR
from chatterscope.functions.numbers import alert_band, round_half_up
from chatterscope.functions.times import recent
from chatterscope.operators.orders import timeline_order


# A series holds one row per hour, so its length is bounded by the hours on record
# (under nine thousand a year) however many posts a keyword has.
def _series():
    return Window.partitionBy("subreddit", "keyword").orderBy("hour_bucket")


def _rolling_mean(frame_rows: int) -> tuple[list[tuple[str, Column]], Column]:
    """Mean of the preceding rows from running totals.

    A sliding frame re-adds all its rows for each row; a difference of two running totals of
    integers is the same number at a constant cost per row.
    """
    steps = [
        ("_rn", F.row_number().over(_series())),
        ("_run", F.sum("frequency").over(_series().rowsBetween(Window.unboundedPreceding, 0))),
        ("_before", F.lag("_run", 1).over(_series())),
        ("_dropped", F.lag("_run", frame_rows + 1, 0).over(_series())),
    ]
    held = F.least(F.col("_rn") - 1, F.lit(frame_rows))
    total = (F.col("_before") - F.coalesce(F.col("_dropped"), F.lit(0))).cast("double")
    return steps, F.when(held > 0, total / held)


def rolling_avg_7d(
    trends: DataFrame, frame_rows: int = ROLLING_ROWS, strict_time: bool = False
) -> DataFrame:
    """Adds the unrounded mean of the series before each row as ``rolling_avg_7d``.

    The frame counts rows. ``strict_time`` counts hours instead: hours without a row then use
    up part of the frame.
    """
    if strict_time:
        frame = (
            f"avg(frequency) OVER (PARTITION BY subreddit, keyword ORDER BY hour_bucket "
            f"RANGE BETWEEN INTERVAL {int(frame_rows)} HOURS PRECEDING "
            f"AND INTERVAL 1 HOURS PRECEDING)"
        )
        return trends.withColumn("rolling_avg_7d", F.expr(frame))
    steps, mean = _rolling_mean(frame_rows)
    out = trends
    for name, column in steps:
        out = out.withColumn(name, column)
    return out.withColumn("rolling_avg_7d", mean).drop(*[name for name, _ in steps])


def cumulative_total(trends: DataFrame, frame_rows: int = ROLLING_ROWS) -> DataFrame:
    """Sum over the preceding rows and the row itself."""
    run = F.sum("frequency").over(_series().rowsBetween(Window.unboundedPreceding, 0))
    dropped = F.lag("_run", frame_rows + 1, 0).over(_series())
    return (
        trends.withColumn("_run", run)
        .withColumn("_dropped", dropped)
        .select(
            "subreddit", "keyword", "hour_bucket", "frequency",
            (F.col("_run") - F.col("_dropped")).alias("cumulative_total"),
        )
    )


def trending_keywords(
    trends: DataFrame,
    frame_rows: int = ROLLING_ROWS,
    factor: float = SPIKE_FACTOR,
    strict_time: bool = False,
) -> DataFrame:
    """Each keyword hour against its own past: mean, spike ratio and trending flag.

    The flag compares unrounded values. Without history it is false; a past of zeros gives no
    ratio but still trends.
    """
    mean = F.col("rolling_avg_7d")
    past = rolling_avg_7d(
        trends.select("subreddit", "keyword", "hour_bucket", "frequency"), frame_rows, strict_time
    )
    return past.select(
        "subreddit", "keyword", "hour_bucket", "frequency",
        round_half_up(mean, 2).alias("rolling_avg_7d"),
        round_half_up(F.col("frequency") / F.nullif(mean, F.lit(0.0)), 2).alias("spike_ratio"),
        F.coalesce(F.col("frequency") > mean * factor, F.lit(False)).alias("is_trending"),
    )


def is_trending_only(trending: DataFrame) -> DataFrame:
    return trending.where("is_trending")


def slicers(trending: DataFrame, keywords=None, start=None, end=None) -> DataFrame:
    """The dashboard's keyword and date-range slicers; each is optional."""
    if keywords is not None:
        trending = trending.where(F.col("keyword").isin(list(keywords)))
    if start is not None:
        trending = trending.where(F.col("hour_bucket") >= start)
    if end is not None:
        trending = trending.where(F.col("hour_bucket") <= end)
    return trending


def top_keywords_now(trending: DataFrame, as_of, hours: int = 6, n: int = 30) -> DataFrame:
    """The most mentioned keywords of the last hours."""
    return (
        recent(trending, "hour_bucket", as_of, hours=hours)
        .groupBy("subreddit", "keyword")
        .agg(
            F.sum("frequency").alias("total_mentions"),
            F.max("spike_ratio").alias("peak_spike_ratio"),
            F.bool_or("is_trending").alias("currently_trending"),
        )
        .orderBy(F.desc("total_mentions"), "subreddit", "keyword")
        .limit(n)
    )


def trend_alerts(trending: DataFrame, as_of, hours: int = 48) -> DataFrame:
    """Keywords that trended lately: peak, normal level, ratio and first sighting."""
    return (
        recent(is_trending_only(trending), "hour_bucket", as_of, hours=hours)
        .groupBy("subreddit", "keyword")
        .agg(
            F.max("frequency").alias("peak_hourly_frequency"),
            F.max("rolling_avg_7d").alias("normal_avg"),
            F.max("spike_ratio").alias("spike_ratio"),
            F.min("hour_bucket").alias("first_detected"),
        )
        .orderBy(F.desc_nulls_first("spike_ratio"), "subreddit", "keyword")
    )


def alert_bands(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("band", alert_band(F.col("spike_ratio")))


def trending_word_cloud(trends_with_flag: DataFrame) -> DataFrame:
    """Total mentions of keywords in the hours in which they trended."""
    return (
        is_trending_only(trends_with_flag)
        .groupBy("keyword")
        .agg(F.sum("frequency").alias("total_frequency"))
    )


def top_keywords(trends: DataFrame, n: int = 15) -> DataFrame:
    return (
        trends.groupBy("keyword")
        .agg(F.sum("frequency").alias("total_frequency"))
        .orderBy(F.desc("total_frequency"), "keyword")
        .limit(n)
    )


def keyword_timeline(trending: DataFrame, as_of, keywords=None, days: int = 7) -> DataFrame:
    """The hourly line of chosen keywords with ratio and flag, newest and unrated first."""
    return (
        slicers(recent(trending, "hour_bucket", as_of, days=days), keywords)
        .select("subreddit", "keyword", "hour_bucket", "frequency", "spike_ratio", "is_trending")
        .orderBy(*timeline_order())
    )
