"""Deleting posts from stored tables, and with them all that was derived from each: copy on write, by partition."""

from __future__ import annotations

from functools import reduce
from operator import or_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatterscope.operators.broadcasts import small
from chatterscope.session import scratch_dir
from chatterscope.sinks.files import remove
from chatterscope.sinks.tables import overwrite_partitions

#: A post and its children lie in partitions of the same name.
PARTITION = ["dt", "batch"]


def touched_partitions(posts: DataFrame, deleted: DataFrame) -> list[tuple]:
    """The partitions that hold posts to be deleted. Only keys are read; the list is as long as there are such partitions."""
    hit = posts.select("post_id", *PARTITION).join(small(deleted.select("post_id")), "post_id", "left_semi")
    return sorted(tuple(r) for r in hit.select(*PARTITION).distinct().collect())


def _within(partitions: list[tuple]) -> Column:
    """A filter on partition columns alone, so that other partitions are not read."""
    batches: dict = {}
    for day, batch in partitions:
        batches.setdefault(day, []).append(batch)
    return reduce(or_, [(F.col("dt") == F.lit(day)) & F.col("batch").isin(names) for day, names in batches.items()])


def delete_posts(spark: SparkSession, deleted: DataFrame, posts_path: str, *child_paths: str) -> list[tuple]:
    """Deletes posts by key from the tables under these paths, and returns the partitions that were rewritten.

    The tables are partitioned by day and batch. What remains of a touched partition is staged for all tables first, then replaces it; one
    of which nothing remains is removed. Other partitions are neither read nor written. If the job is lost on the way it can be run again: children go before their posts, so that the partitions are found
    once more. Keys that are not stored are ignored, repeated ones count once.
    """
    keys = deleted.select("post_id").distinct()
    touched = touched_partitions(spark.read.parquet(posts_path), keys)
    if not touched:
        return []
    staged = []
    for path in (*child_paths, posts_path):
        table = spark.read.parquet(path)
        rest = table.where(_within(touched)).join(small(keys), "post_id", "left_anti").select(table.columns)
        staging = scratch_dir(spark, "cascade")
        rest.write.parquet(staging)
        staged.append((path, spark.read.schema(table.schema).parquet(staging), staging))
    for path, rest, staging in staged:
        left = {tuple(r) for r in rest.select(*PARTITION).distinct().collect()}
        overwrite_partitions(rest, path, *PARTITION)
        for day, batch in touched:
            if (day, batch) not in left:
                remove(spark, f"{path}/dt={day}/batch={quote(str(batch), safe=' ')}")
        remove(spark, staging)
    return touched
