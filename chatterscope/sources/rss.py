"""Feed items from landed XML files, one folder ``feed=<name>`` per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from chatterscope.constants import LEGACY_KEY_CHARS
from chatterscope.functions.times import timestamp
from chatterscope.operators.broadcasts import small
from chatterscope.schemas import RSS_ITEM
from chatterscope.sources.isolated import read_isolated


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """All ``<item>`` elements with the name of their feed; broken ones in ``_corrupt_record``."""
    schema = T.StructType([*RSS_ITEM.fields, T.StructField("feed", T.StringType())])
    return (
        spark.read.format("xml")
        .option("rowTag", "item")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .schema(schema)
        .load(path)
    )


def stream_items(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same files as a stream; each item has the name of the feed whose folder it came from."""
    source = spark.readStream.format("xml").option("rowTag", "item").option("columnNameOfCorruptRecord", "_corrupt_record")
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    items = source.schema(RSS_ITEM).option("recursiveFileLookup", "true").load(path)
    feed = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "/feed=([^/]+)/", 1))
    return items.withColumn("feed", F.nullif(feed, F.lit("")))


def item_key() -> Column:
    return F.coalesce(F.col("guid._VALUE"), F.col("link"), F.col("title"))


def rss_key(items: DataFrame) -> DataFrame:
    """Adds the key of each item: 120 bits of a hash of the full identifier.

    Cutting the identifier to 20 characters, kept as ``legacy_key``, makes different addresses
    of one site collide.
    """
    digest = F.base64(F.unhex(F.sha2(item_key(), 256)))
    return items.withColumns({
        "post_id": F.substring(digest, 1, 20),
        "legacy_key": F.left(item_key(), F.lit(LEGACY_KEY_CHARS)),
    })


def feed_topic_join(items: DataFrame, feed_map: DataFrame) -> DataFrame:
    """Items with the topic of their feed; null for a feed that is not in the map."""
    return items.join(small(feed_map.select("feed", "topic")), "feed", "left")


_DATES = r"(?i)^(?:[a-z]{3},\s*)?(\d{1,2}) ([a-z]{3}) (\d{4}) (\d{2}:\d{2}(?::\d{2})?) ?([a-z]{1,4}|[+-]\d{2}:?\d{2})?$"
_ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?) ?(Z|[+-]\d{2}:?\d{2})?$"
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
#: Hours from UTC of the zone names that the mail format knows.
_ZONES = {"gmt": 0, "ut": 0, "utc": 0, "z": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}


def published_at() -> Column:
    """The item's own date in UTC, in the mail format or as ISO; null if it has none that is known.

    The weekday, seconds and zone may be missing; without a zone it is taken as UTC.
    """
    date = F.trim("pubDate")

    def group(pattern: str, n: int) -> Column:
        return F.nullif(F.regexp_extract(date, pattern, n), F.lit(""))

    month = F.nullif(F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(group(_DATES, 2))), F.lit(0))
    mail = F.concat_ws("-", group(_DATES, 3), F.lpad(month, 2, "0"), F.lpad(group(_DATES, 1), 2, "0"))
    day = F.coalesce(group(_ISO, 1), F.when(month.isNotNull(), mail))
    clock = F.coalesce(group(_ISO, 2), group(_DATES, 4))
    zone = F.lower(F.coalesce(group(_ISO, 3), group(_DATES, 5), F.lit("utc")))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    offset = (digits.substr(1, 2).try_cast("int") * 60 + digits.substr(3, 2).try_cast("int")) * F.when(zone.startswith("-"), -1).otherwise(1)
    named = F.lit(None).cast("int")
    for name, hours in _ZONES.items():
        named = F.when(zone == name, hours * 60).otherwise(named)
    minutes = F.coalesce(named, offset)
    return F.concat_ws(" ", day, clock).try_cast("timestamp_ntz") - F.make_dt_interval(mins=minutes)


def items_to_posts(
    items: DataFrame, feed_map: DataFrame, as_of, use_published: bool = False
) -> DataFrame:
    """Feed items as posts. ``created_utc`` is the time of collection unless asked otherwise.

    The items of a feed that is not in the map are kept under the feed's name.
    """
    collected = timestamp(as_of)
    created = F.coalesce(published_at(), collected) if use_published else collected
    return (
        rss_key(feed_topic_join(items, feed_map))
        .select(
            "post_id",
            F.lit("rss").alias("source"),
            F.coalesce("topic", "feed").alias("subreddit"),
            F.coalesce("title", F.lit("")).alias("title"),
            created.alias("created_utc"),
        )
    )


def read_rss(
    spark: SparkSession, path: str, feed_map: DataFrame, as_of, use_published: bool = False
) -> DataFrame:
    """The posts of all items that parse; ``read_feeds`` tells what does not."""
    whole = read_items(spark, path).where(F.col("_corrupt_record").isNull())
    return items_to_posts(whole, feed_map, as_of, use_published)


def read_feeds(
    spark: SparkSession, path: str, feed_map: DataFrame, as_of, use_published: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The posts of a folder of feeds, and a row (file, line, reason) for each item and file that can't be read."""
    schema = T.StructType([*RSS_ITEM.fields, T.StructField("feed", T.StringType())])
    items, refused = read_isolated(spark, path, "xml", schema, rowTag="item")
    return items_to_posts(items, feed_map, as_of, use_published), refused
