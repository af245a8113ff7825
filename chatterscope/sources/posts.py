"""Posts from landed files, and the choice of which to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from chatterscope.constants import (
    DEFAULT_TARGETS, DELETED_AUTHOR, LISTING_LIMIT,
)
from chatterscope.functions.times import epoch_of, from_epoch
from chatterscope.operators.toplists import top_n_per_group
from chatterscope.schemas import LANDED_POST


def _reader(source, path: str, fmt: str):
    if fmt == "json":
        source = source.option("columnNameOfCorruptRecord", "_corrupt_record")
        return source.schema(LANDED_POST).format(fmt).load(path)
    return source.schema(_columns()).format(fmt).load(path)


def _columns():
    """The landed columns without the one that only text formats fill."""
    return StructType([f for f in LANDED_POST.fields if f.name != "_corrupt_record"])


def read_posts(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed posts as delivered. Lines that do not parse keep their text in ``_corrupt_record``."""
    return _reader(spark.read, path, fmt)


def stream_posts(
    spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """The same files as a stream."""
    source = spark.readStream
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return _reader(source, path, fmt)


def parsed(landed: DataFrame) -> DataFrame:
    """Only the lines that parsed."""
    if "_corrupt_record" not in landed.columns:
        return landed
    return landed.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def unparsed(landed: DataFrame) -> DataFrame:
    """The lines that did not parse, their text in a column ``line``, with what was read of the title.

    Spark refuses to read broken lines alone from raw files, hence the second column.
    """
    title = F.col("title").cast("string").alias("title")
    if "_corrupt_record" not in landed.columns:
        return landed.select(F.lit(None).cast("string").alias("line"), title).where(F.lit(False))
    broken = landed.where(F.col("_corrupt_record").isNotNull())
    return broken.select(F.col("_corrupt_record").alias("line"), title)


def normalize_post(landed: DataFrame, body_chars: int | None = None) -> DataFrame:
    """Landed posts in the stored shape.

    Bodies are kept whole unless ``body_chars`` sets the length to cut them to.
    """
    body = F.col("body") if body_chars is None else F.left(F.col("body"), F.lit(body_chars))
    return landed.select(
        "post_id", "source", "subreddit", "title",
        F.nullif(body, F.lit("")).alias("body"),
        F.coalesce("author", F.lit(DELETED_AUTHOR)).alias("author"),
        "url", "score", "num_comments",
        from_epoch(F.col("created_epoch")).alias("created_utc"),
    )


def select_listing(posts: DataFrame, sort: str = "new", limit: int = LISTING_LIMIT) -> DataFrame:
    """The first posts of each subreddit's listing; an unknown ``sort`` means "new".

    "hot" is ranked by the published log-score-plus-age formula and is an approximation.
    """
    score = F.col("score")
    age = epoch_of(F.col("created_utc")) / 45000
    orders = {
        "new": F.desc("created_utc"),
        "top": F.desc("score"),
        "hot": F.desc(F.log10(F.greatest(F.abs(score), F.lit(1))) * F.signum(score) + age),
    }
    order = orders.get(sort, orders["new"])
    return top_n_per_group(posts, ["subreddit"], [order, F.col("post_id")], limit)


def read_targets(
    posts: DataFrame, targets: str = DEFAULT_TARGETS, sort: str = "new", limit: int = LISTING_LIMIT
) -> DataFrame:
    """The listings of a comma-separated list of subreddits.

    The names become an IN filter, which reaches the scan.
    """
    names = [name.strip() for name in targets.split(",")]
    return select_listing(posts.where(F.col("subreddit").isin(names)), sort, limit)


def union_sources(*posts: DataFrame) -> DataFrame:
    """All posts of several sources, duplicates kept; missing columns become null."""
    first, *others = posts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
