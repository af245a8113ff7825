"""Relational views and tiles over posts, sentiment and entities.

The joins carry no hint: both sides are keyed by ``post_id``, unique in posts and in sentiment,
so a key cannot be hot, and Spark picks broadcast or sort-merge from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatterscope.constants import SURGE_ENTITY_TYPES
from chatterscope.functions.numbers import (
    exact_mean, percent, round_half_up, sentiment_colour, sentiment_label,
)
from chatterscope.functions.times import (
    day_of, days_before, hour_of, hours_before, on_day, recent,
)


def posts_join_sentiment(posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    return posts.join(sentiment, "post_id")


def entities_posts_sentiment(
    entities: DataFrame, posts: DataFrame, sentiment: DataFrame
) -> DataFrame:
    return entities.join(posts, "post_id").join(sentiment, "post_id")


def entity_type_in(entities: DataFrame, types: list[str] | None = None) -> DataFrame:
    return entities.where(F.col("entity_type").isin(types or SURGE_ENTITY_TYPES))


def label_shares() -> list[Column]:
    """Shares of the three labels among the rows of a group, in percent."""
    return [
        percent(F.count_if(F.col("label") == label), F.count(F.lit(1))).alias(f"{label}_pct")
        for label in ("positive", "negative", "neutral")
    ]


def label_pct(sentiment: DataFrame, *by: str) -> DataFrame:
    return sentiment.groupBy(*by).agg(*label_shares())


def sentiment_by_hour(posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    return (
        posts_join_sentiment(
            posts.select("post_id", "subreddit", "created_utc"),
            sentiment.select("post_id", "compound", "label"),
        )
        .groupBy(hour_of(F.col("created_utc")).alias("hour_bucket"), "subreddit")
        .agg(
            F.count(F.lit(1)).alias("total_posts"),
            round_half_up(exact_mean(F.col("compound")), 3).alias("avg_sentiment"),
            *label_shares(),
        )
    )


def sentiment_line(posts: DataFrame, sentiment: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Hourly sentiment of the last days.

    Filtering the raw time first is implied by the bucket filter and reaches the scan.
    """
    lately = recent(posts, "created_utc", as_of, days=days)
    return (
        recent(sentiment_by_hour(lately, sentiment), "hour_bucket", as_of, days=days)
        .select(
            "hour_bucket", "subreddit", "avg_sentiment", "positive_pct", "negative_pct", "total_posts"
        )
        .orderBy("hour_bucket", "subreddit")
    )


def sentiment_gauge(posts: DataFrame, sentiment: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Posts per label in the last hours and their share of all."""
    lately = posts.where(F.col("created_utc") >= hours_before(as_of, hours)).select("post_id")
    counts = (
        posts_join_sentiment(lately, sentiment.select("post_id", "label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return pct_of_total(counts, "count").orderBy(F.desc("count"), "label")


def pct_of_total(counts: DataFrame, column: str) -> DataFrame:
    """Adds each row's share of the total, which is summed in the tasks and joined as one number."""
    return counts.withColumn("percentage", percent(F.col(column), counts.agg(F.sum(column)).scalar()))


def entity_surge(entities: DataFrame, posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Posts that name an entity, per day and subreddit, with their mean sentiment."""
    return (
        entities_posts_sentiment(
            entity_type_in(entities).select("post_id", "entity_text", "entity_type"),
            posts.select("post_id", "subreddit", "created_utc"),
            sentiment.select("post_id", "compound"),
        )
        .groupBy(
            "entity_text", "entity_type", "subreddit",
            day_of(F.col("created_utc")).alias("day_bucket"),
        )
        .agg(
            F.count(F.lit(1)).alias("mention_count"),
            round_half_up(exact_mean(F.col("compound")), 3).alias("avg_sentiment"),
        )
    )


def top_entities(
    entities: DataFrame, posts: DataFrame, sentiment: DataFrame, as_of, days: int = 7, n: int = 50
) -> DataFrame:
    """The most mentioned entities of the last days.

    The day bucket is compared with the exact edge, so the oldest, partial day stays out.
    """
    edge = days_before(as_of, days)
    surge = entity_surge(entities, posts.where(F.col("created_utc") >= edge), sentiment)
    return (
        surge.where(F.col("day_bucket") >= edge)
        .groupBy("entity_text", "entity_type")
        .agg(
            F.sum("mention_count").alias("total_mentions"),
            round_half_up(exact_mean(F.col("avg_sentiment")), 3).alias("avg_sentiment"),
            F.count_distinct("subreddit").alias("subreddit_spread"),
        )
        .orderBy(F.desc("total_mentions"), "entity_text", "entity_type")
        .limit(n)
    )


def entity_table(surge: DataFrame) -> DataFrame:
    return (
        surge.groupBy("entity_text", "entity_type")
        .agg(
            F.sum("mention_count").alias("total_mentions"),
            round_half_up(exact_mean(F.col("avg_sentiment")), 3).alias("avg_sentiment"),
        )
        .withColumn("colour", sentiment_colour(F.col("avg_sentiment")))
        .orderBy(F.desc("total_mentions"), "entity_text", "entity_type")
    )


def entity_type_breakdown(surge: DataFrame) -> DataFrame:
    return surge.groupBy("entity_type", "subreddit").agg(F.count(F.lit(1)).alias("count"))


def daily_summary(
    posts: DataFrame,
    sentiment: DataFrame,
    as_of=None,
    entities: DataFrame | None = None,
    keywords: DataFrame | None = None,
) -> DataFrame:
    """Daily totals per subreddit; ``as_of`` keeps that day only.

    With entities or keywords given, the day's top term is added too.
    """
    if as_of is not None:
        posts = on_day(posts, "created_utc", as_of)
        keywords = None if keywords is None else on_day(keywords, "hour_bucket", as_of)
    days = (
        posts_join_sentiment(
            posts.select("post_id", "subreddit", "created_utc"),
            sentiment.select("post_id", "compound", "label"),
        )
        .groupBy(F.to_date("created_utc").alias("summary_date"), "subreddit")
        .agg(
            F.count(F.lit(1)).alias("total_posts"),
            exact_mean(F.col("compound")).alias("avg_sentiment"),
            *label_shares(),
        )
    )
    for terms in (
        None if entities is None else daily_top_entity(entities, posts),
        None if keywords is None else daily_top_keyword(keywords),
    ):
        if terms is not None:
            days = days.alias("d").join(
                terms.alias("t"),
                (F.col("d.summary_date") == F.col("t.summary_date"))
                & F.col("d.subreddit").eqNullSafe(F.col("t.subreddit")),
                "left",
            ).select("d.*", f"t.{terms.columns[-1]}")
    return days


def _top_term(totals: DataFrame, name: str) -> DataFrame:
    """The largest term per day and subreddit, ties by name. One row per group and task is
    shuffled, as the rank limit is applied before the exchange."""
    order = Window.partitionBy("summary_date", "subreddit").orderBy(F.desc("_total"), "_term")
    return (
        totals.withColumn("_rank", F.row_number().over(order))
        .where("_rank = 1")
        .select("summary_date", "subreddit", F.col("_term").alias(name))
    )


def daily_top_entity(entities: DataFrame, posts: DataFrame) -> DataFrame:
    totals = (
        entities.join(posts.select("post_id", "subreddit", "created_utc"), "post_id")
        .groupBy(
            F.to_date("created_utc").alias("summary_date"), "subreddit",
            F.col("entity_text").alias("_term"),
        )
        .agg(F.sum("mention_count").alias("_total"))
    )
    return _top_term(totals, "top_entity")


def daily_top_keyword(keywords: DataFrame) -> DataFrame:
    totals = keywords.groupBy(
        F.to_date("hour_bucket").alias("summary_date"), "subreddit",
        F.col("keyword").alias("_term"),
    ).agg(F.sum("frequency").alias("_total"))
    return _top_term(totals, "top_keyword")


def kpi_cards(by_hour: DataFrame) -> DataFrame:
    """The four cards: unweighted means over the hourly rows, and the number of posts."""
    return by_hour.agg(
        round_half_up(exact_mean(F.col("avg_sentiment")), 3).alias("avg_sentiment"),
        round_half_up(exact_mean(F.col("positive_pct")), 1).alias("positive_pct"),
        round_half_up(exact_mean(F.col("negative_pct")), 1).alias("negative_pct"),
        F.sum("total_posts").alias("total_posts"),
    )


def label_donut(sentiment: DataFrame) -> DataFrame:
    """Posts per label, the label taken from the compound score."""
    return sentiment.groupBy(sentiment_label(F.col("compound")).alias("sentiment")).agg(
        F.count(F.lit(1)).alias("posts")
    )
