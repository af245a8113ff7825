"""Low-latency streams: duplicates dropped and hourly sentiment counted as posts arrive.

They keep state only within the watermark. What arrives later is left to the pipeline, which works
out touched days again and is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterscope.functions.numbers import exact_mean, round_half_up
from chatterscope.functions.times import epoch_of, from_epoch
from chatterscope.operators.summaries import label_shares
from chatterscope.sinks.keys import KeyIndex
from chatterscope.sinks.tables import first_per_key, overwrite_partitions
from chatterscope.streaming.batches import start_batches

LATENESS = "2 hours"


def _timed(posts: DataFrame) -> DataFrame:
    """Watermarks need a timestamp with a zone. It is made from the epoch, as the session's zone must play no part."""
    return posts.withColumn("_event", F.timestamp_seconds(epoch_of(F.col("created_utc"))))


def stream_dedup(posts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The first arrival of each post, as far back as the watermark reaches."""
    kept = _timed(posts).withWatermark("_event", lateness).dropDuplicatesWithinWatermark(["post_id"])
    return kept.drop("_event")


def start_exact_dedup(
    posts: DataFrame, path: str, checkpoint: str, every: str | None = None, key_buckets: int = 64
) -> StreamingQuery:
    """Stores each post of a stream once, however late it or a copy of it comes.

    No state is kept: each micro-batch meets the index of the keys stored so far. Rows are partitioned by batch, so a batch that is
    repeated replaces its own rows.
    """
    index = KeyIndex(f"{path}-keys", buckets=key_buckets)

    def on_batch(rows: DataFrame, batch: str) -> None:
        order = [F.col("created_utc"), F.hash(*rows.columns)]
        fresh = first_per_key(rows, ["post_id"], order).join(index.known(rows, batch), "post_id", "left_anti")
        overwrite_partitions(fresh.withColumn("batch", F.lit(batch)), path, "batch")
        stored = rows.sparkSession.read.schema("post_id string, batch string").parquet(path)
        index.add(stored.where(F.col("batch") == batch), batch)

    return start_batches(posts, checkpoint, on_batch, every)


def stream_hourly_sentiment(scored: DataFrame, lateness: str | None = LATENESS) -> DataFrame:
    """Sentiment per hour and subreddit over scored posts.

    ``lateness=None`` is for batch frames.
    """
    timed = _timed(scored)
    if lateness is not None:
        timed = timed.withWatermark("_event", lateness)
    return (
        timed.groupBy(F.window("_event", "1 hour"), "subreddit")
        .agg(
            F.count(F.lit(1)).alias("total_posts"),
            round_half_up(exact_mean(F.col("compound")), 3).alias("avg_sentiment"),
            *label_shares(),
        )
        .select(
            from_epoch(F.unix_seconds("window.start")).alias("hour_bucket"),
            "subreddit", "total_posts", "avg_sentiment", "positive_pct", "negative_pct", "neutral_pct",
        )
    )


def dropped_late(progress) -> int:
    """How many rows a finished progress report lost to the watermark."""
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
