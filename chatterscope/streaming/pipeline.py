"""The hourly job as a stream: new posts in, all tables brought up to date per micro-batch."""

from __future__ import annotations

import datetime as dt
import logging
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chatterscope import resources
from chatterscope.operators.broadcasts import small
from chatterscope.operators.entities import extract_from_posts
from chatterscope.operators.keywords import keyword_trends, merged_counts, word_counts
from chatterscope.operators.sentiment import lexicon_sentiment, title_sentiment
from chatterscope.operators.summaries import daily_summary
from chatterscope.schemas import (
    EXTRACTED_ENTITIES, KEYWORD_TRENDS, RAW_POSTS, SENTIMENT_SCORES, WORD_COUNTS,
)
from chatterscope.session import scratch_dir
from chatterscope.sinks.cascade import delete_posts
from chatterscope.sinks.files import remove
from chatterscope.sinks.keys import KeyIndex
from chatterscope.sinks.tables import (
    first_per_key, overwrite_partitions, quarantined, read_table, upsert_daily_summary, valid,
    validate_contract, write_keyword_trends,
)
from chatterscope.sources.posts import normalize_post, parsed, unparsed
from chatterscope.sources.rss import items_to_posts
from chatterscope.streaming.batches import start_batches

logger = logging.getLogger(__name__)

_PARTITIONS = [T.StructField("dt", T.DateType()), T.StructField("batch", T.StringType())]
_HOUR = T.StructField("hr", T.IntegerType())


def _stored(schema: T.StructType, *drop: str) -> T.StructType:
    return T.StructType([*(f for f in schema.fields if f.name not in drop), *_PARTITIONS])


@dataclass
class Tables:
    """Folder layout. Posts and their children are partitioned by day and batch, so a repeated
    batch replaces its own rows and a day is read without its neighbours. Keywords are partitioned by hour,
    as a post that comes late changes its hour alone."""

    root: str
    key_buckets: int = 64

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def raw_posts(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("raw_posts"), _stored(RAW_POSTS, "collected_at"))

    def sentiment_scores(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("sentiment_scores"), _stored(SENTIMENT_SCORES, "scored_at"))

    def extracted_entities(self, spark: SparkSession) -> DataFrame:
        return read_table(
            spark, self.path("extracted_entities"), _stored(EXTRACTED_ENTITIES, "extracted_at")
        )

    def keyword_trends(self, spark: SparkSession) -> DataFrame:
        fields = [f for f in KEYWORD_TRENDS.fields if f.name != "recorded_at"]
        schema = T.StructType([*fields, T.StructField("dt", T.DateType()), _HOUR])
        return read_table(spark, self.path("keyword_trends"), schema).drop("hr")

    def post_keys(self, spark: SparkSession) -> KeyIndex:
        """The index of the stored posts' keys, made first for tables that have none yet."""
        index = KeyIndex(self.path("post_keys"), buckets=self.key_buckets)
        if not index.exists(spark):
            index.build(self.raw_posts(spark))
        return index

    def word_counts(self, spark: SparkSession) -> DataFrame:
        """What each batch added to the words of an hour; ``merged_counts`` makes them the hour's."""
        return read_table(spark, self.path("word_counts"), T.StructType([*WORD_COUNTS.fields, *_PARTITIONS]))

    def daily_summary(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path("daily_summary"))


@dataclass
class SideTables:
    lexicon: DataFrame
    modifiers: DataFrame
    gazetteer: DataFrame
    idioms: DataFrame | None = None
    emoji: DataFrame | None = None

    @classmethod
    def shipped(cls, spark: SparkSession) -> SideTables:
        names = ("lexicon", "modifiers", "gazetteer", "idioms", "emoji")
        return cls(*[getattr(resources, name)(spark) for name in names])


def run_batch(
    landed: DataFrame,
    batch: str,
    tables: Tables,
    sides: SideTables,
    body_chars: int | None = None,
    lengths: bool = False,
) -> None:
    """Brings all tables up to date with one batch of landed posts.

    Lines that do not parse and posts that break the contract go to the quarantine, with the
    reason; ``lengths`` counts overlong strings among these. Every step overwrites partitions that it derives from stored rows, so a batch that is run again
    after a crash, at any point, ends in the same tables. ``batch`` must name the batch uniquely.
    """
    if landed.isEmpty():
        logger.warning("no posts in batch %s", batch)
        return
    started = time.monotonic()
    spark = landed.sparkSession
    checked = validate_contract(normalize_post(parsed(landed), body_chars), "raw_posts", lengths)
    refused = quarantined(checked).unionByName(
        unparsed(landed).withColumn("violations", F.array(F.lit("does not parse"))), allowMissingColumns=True
    )
    overwrite_partitions(refused.withColumn("batch", F.lit(batch)), tables.path("quarantine"), "batch")
    # From here on everything reads the stored posts, also after the loss of an executor.
    new = store_new_posts(valid(checked), batch, tables, [F.col("created_utc"), F.col("title"), F.col("body")])
    posts = tables.raw_posts(spark)
    overwrite_partitions(
        lexicon_sentiment(new, sides.lexicon, sides.modifiers, ("dt", "batch"), sides.idioms, sides.emoji),
        tables.path("sentiment_scores"), "dt", "batch",
    )
    overwrite_partitions(
        extract_from_posts(new, sides.gazetteer).join(new.select("post_id", "dt", "batch"), "post_id"),
        tables.path("extracted_entities"), "dt", "batch",
    )

    refresh_keywords(spark, new, batch, tables)

    # Late posts change the summary of their own day, so touched days are added up again, from narrow tables.
    days = small(new.select("dt").distinct())
    touched = posts.join(days, "dt", "left_semi")
    scores = tables.sentiment_scores(spark).join(days, "dt", "left_semi")
    entities = tables.extracted_entities(spark).join(days, "dt", "left_semi")
    keywords = tables.keyword_trends(spark).join(days, "dt", "left_semi")
    upsert_daily_summary(
        daily_summary(touched, scores, entities=entities, keywords=keywords),
        tables.path("daily_summary"),
    )
    logger.info("batch %s done in %.1f s", batch, time.monotonic() - started)


def store_new_posts(posts: DataFrame, batch: str, tables: Tables, order: list[Column]) -> DataFrame:
    """Stores the posts whose keys no other batch has brought, the first of each, and returns what is stored of this batch.

    Known keys come from the index of keys, so the stored posts are not scanned. A batch that is repeated, after a crash at any
    point, stores the same rows.
    """
    spark = posts.sparkSession
    index = tables.post_keys(spark)
    added = first_per_key(posts, ["post_id"], order).join(index.known(posts, batch), "post_id", "left_anti")
    overwrite_partitions(
        added.withColumns({"dt": F.to_date("created_utc"), "batch": F.lit(batch)}),
        tables.path("raw_posts"), "dt", "batch",
    )
    new = tables.raw_posts(spark).where(F.col("batch") == batch)
    index.add(new, batch)
    return new


def delete_stored_posts(deleted: DataFrame, tables: Tables) -> list[tuple]:
    """Deletes posts, their scores and entities, and forgets their keys; daily rows and keywords stay as they were counted."""
    spark = deleted.sparkSession
    touched = delete_posts(spark, deleted, *map(tables.path, ("raw_posts", "sentiment_scores", "extracted_entities")))
    if touched:
        tables.post_keys(spark).forget(deleted)
    return touched


def refresh_keywords(spark: SparkSession, new: DataFrame, batch: str, tables: Tables) -> None:
    """Brings the keywords of the hours of new stored posts up to date, and of these alone.

    The words of the new posts are counted and stored next to those of earlier batches; the hours' totals are sums of
    these rows. Only the texts of the touched hours are read again, for pairs and weights.
    """
    hour = F.hour("created_utc").alias("hr")
    counts = word_counts(new).withColumns({"dt": F.to_date("hour_bucket"), "batch": F.lit(batch)})
    overwrite_partitions(counts, tables.path("word_counts"), "dt", "batch")
    hours = small(new.select("dt", hour).distinct())
    stored = tables.word_counts(spark).withColumn("hr", F.hour("hour_bucket"))
    totals = merged_counts(stored.join(hours, ["dt", "hr"], "left_semi"))
    texts = tables.raw_posts(spark).withColumn("hr", hour).join(hours, ["dt", "hr"], "left_semi")
    stage = scratch_dir(spark, "keywords")
    write_keyword_trends(keyword_trends(texts, counts=totals, stage=stage), tables.path("keyword_trends"))
    remove(spark, stage)


def run_rss_batch(
    items: DataFrame,
    batch: str,
    tables: Tables,
    sides: SideTables,
    feed_map: DataFrame,
    as_of,
    use_published: bool = False,
) -> None:
    """Feed items to stored posts and the sentiment of their titles.

    Known items are skipped, so delivering a feed again adds nothing. Items that do not parse go to
    the quarantine. A batch that is repeated replaces its own rows, and those of no batch of posts of the same name.
    """
    spark, batch = items.sparkSession, f"rss-{batch}"
    posts = items_to_posts(parsed(items), feed_map, as_of, use_published)
    missing = [f for f in RAW_POSTS.fields if f.name not in (*posts.columns, "collected_at")]
    whole = posts.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    checked = validate_contract(whole, "raw_posts", lengths=False)
    refused = quarantined(checked).unionByName(
        unparsed(items).withColumn("violations", F.array(F.lit("does not parse"))), allowMissingColumns=True
    )
    overwrite_partitions(refused.withColumn("batch", F.lit(batch)), tables.path("quarantine"), "batch")
    new = store_new_posts(valid(checked), batch, tables, [F.col("created_utc"), F.col("title")])
    overwrite_partitions(
        title_sentiment(new, sides.lexicon, sides.modifiers, ("dt", "batch"), sides.idioms, sides.emoji),
        tables.path("sentiment_scores"), "dt", "batch",
    )


def start_pipeline(
    posts: DataFrame,
    root: str,
    checkpoint: str,
    sides: SideTables | None = None,
    every: str | None = None,
    body_chars: int | None = None,
    lengths: bool = False,
    tables: Tables | None = None,
) -> StreamingQuery:
    """Starts the job on a stream of landed posts.

    Without ``every`` it works off what has landed and stops, to be run by cron. With, for
    example, ``every="60 minutes"`` it stays up.
    """
    spark = posts.sparkSession
    tables, sides = tables or Tables(root), sides or SideTables.shipped(spark)

    def on_batch(landed: DataFrame, name: str) -> None:
        run_batch(landed, name, tables, sides, body_chars, lengths)

    return start_batches(posts, checkpoint, on_batch, every)


def start_feeds(
    items: DataFrame,
    root: str,
    checkpoint: str,
    feed_map: DataFrame,
    as_of=None,
    sides: SideTables | None = None,
    every: str | None = None,
    use_published: bool = False,
    tables: Tables | None = None,
) -> StreamingQuery:
    """The job on a stream of landed feed items, next to that of posts and into the same tables.

    ``as_of`` is the time of collection; by default it is the time at which a batch is handled.
    """
    spark = items.sparkSession
    tables, sides = tables or Tables(root), sides or SideTables.shipped(spark)

    def on_batch(landed: DataFrame, name: str) -> None:
        collected = as_of if as_of is not None else dt.datetime.now(dt.timezone.utc)
        run_rss_batch(landed, name, tables, sides, feed_map, collected, use_published)

    return start_batches(items, checkpoint, on_batch, every)
