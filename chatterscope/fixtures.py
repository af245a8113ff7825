"""The given test tables in the shape of the engine's own tables.

Every table is derived row by row from the whole given table and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatterscope.functions.numbers import sentiment_label
from chatterscope.functions.times import epoch_of, hour_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k(props):
    return F.regexp_extract(props, r"(\d+)", 1).cast("int")


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts: the first line is the title, the rest the body."""
    documents, events = table(spark, folder, "documents"), table(spark, folder, "events")
    title = F.substring_index("text", "\n", 1)
    return (
        # Both tables are large in principle, so the join shuffles on the key. This also spreads the
        # texts, which here lie in a single file, over all cores.
        documents.join(events.hint("merge"), documents.doc_id == events.event_id)
        .select(
            F.concat(F.lit("d"), F.col("doc_id")).alias("post_id"),
            F.when(F.col("doc_id") % 5 == 0, F.lit("rss")).otherwise(F.lit("reddit")).alias("source"),
            F.col("lang").alias("subreddit"),
            title.alias("title"),
            F.nullif(F.substring(F.col("text"), F.length(title) + 2, F.length("text")), F.lit(""))
            .alias("body"),
            F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("u"), F.col("user_id"))).alias("author"),
            F.lit(None).cast("string").alias("url"),
            F.floor("value").cast("int").alias("score"),
            _k(F.col("props")).alias("num_comments"),
            F.col("ts").alias("created_utc"),
        )
    )


def landed_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The same posts as a listing delivers them: epoch seconds instead of a timestamp."""
    return raw_posts(spark, folder).select(
        "post_id", "source", "subreddit", "title", "body", "author", "url", "score", "num_comments",
        epoch_of(F.col("created_utc")).cast("double").alias("created_epoch"),
    )


def wide_posts(spark: SparkSession, folder: str) -> DataFrame:
    """One post per event, over 30 days; no prose."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("d"), F.col("event_id")).alias("post_id"),
        F.col("event_type").alias("subreddit"),
        F.col("props").alias("title"),
        F.col("ts").alias("created_utc"),
    )


def sentiment(spark: SparkSession, folder: str) -> DataFrame:
    compound = (F.round(F.col("value") * 100).cast("long") % 201 - 100) / F.lit(100.0)
    return (
        table(spark, folder, "events")
        .select(F.concat(F.lit("d"), F.col("event_id")).alias("post_id"), compound.alias("compound"))
        .select(
            "post_id", "compound",
            F.greatest(F.col("compound"), F.lit(0.0)).alias("positive"),
            F.greatest(-F.col("compound"), F.lit(0.0)).alias("negative"),
            (F.lit(1.0) - F.abs("compound")).alias("neutral"),
            sentiment_label(F.col("compound")).alias("label"),
        )
    )


def keyword_trends(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy(
            F.col("event_type").alias("subreddit"),
            F.concat(F.lit("u"), F.col("user_id") % 3).alias("keyword"),
            hour_of(F.col("ts")).alias("hour_bucket"),
        )
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def entities(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("user_id") % 4
    return table(spark, folder, "events").select(
        F.concat(F.lit("d"), F.col("event_id")).alias("post_id"),
        F.concat(F.lit("Brand "), F.col("user_id") % 12).alias("entity_text"),
        F.when(kind == 0, F.lit("ORG")).when(kind == 1, F.lit("PERSON"))
        .when(kind == 2, F.lit("PRODUCT")).otherwise(F.lit("GPE")).alias("entity_type"),
        (_k(F.col("props")) % 3 + 1).cast("long").alias("mention_count"),
    )


def rss_items(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as feed items, spread over the four known feeds."""
    from chatterscope.constants import FEEDS

    names = F.array(*[F.lit(name) for name, _, _ in FEEDS])
    return table(spark, folder, "pages").select(
        F.get(names, (F.col("page_id") % len(FEEDS)).cast("int")).alias("feed"),
        F.struct(F.col("url").alias("_VALUE"), F.lit("false").alias("_isPermaLink")).alias("guid"),
        F.col("url").alias("link"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )


#: One for each rule of idioms, emoji and "least"; each title takes one by its key.
RULE_PHRASES = [
    "they live at the bus stop", "a broken heart and a beating heart", "not to die for", "Very BAD ASS, says the crowd!",
    "yeah right broken heart", "kiss of death", "to die", "the least effective of all", "at least effective", "The VERY least effective",
    "least", "not the least bit good", "😢😢 and 💔!", "so 👍good ❤️ it", "all is well 😂", "the bomb 🔥, the shit", "nothing",
]


#: One for each rule of entities: stop entities, phrases within phrases, ends of sentences and lines, ties beyond the twentieth.
ENTITY_PHRASES = [
    "Google and Google DeepMind, Google DeepMind", "the GNU General Public License and the General Public License", "Facebook, Amazon; Twitter",
    "Apple Apple Apple. Apache License, Apache Software Foundation", "Elon. Musk, Elon\nMusk and Elon Musk", "apple, GPT-4 or gpt-4 on Windows",
    "China India Japan Germany France Spain Italy Canada Brazil Russia Ukraine London Paris Berlin Madrid Tokyo Beijing Tesla Sony Intel IBM Meta Apple Apple",
    "nothing", "World Health Organization of the United Nations", "(Goldman Sachs) Reddit's New York",
]

#: Entity texts with something to clean or a reason to be dropped.
ENTITY_TEXTS = [
    "  gpt-5 pro-max ", "Monday", "THE", "a", " x ", "12 34", "--", "  ", "", "december", "the end", "üNITED é", "7", "!?", "é",
    "AMAZON", "amazon web services", "new\tyork\n", "3m", "x2",
]


def chosen(values: list[str]) -> Column:
    """One of the values for each post, by its key."""
    number = F.conv(F.substring(F.md5("post_id"), 1, 6), 16, 10).cast("long")
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def phrased_posts(spark: SparkSession, folder: str, phrases: list[str]) -> DataFrame:
    """The posts, with a phrase after each title."""
    return raw_posts(spark, folder).withColumn("title", F.concat("title", F.lit(" "), chosen(phrases)))
