"""The orders in which results are shown, and each row's place in one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chatterscope.session import scratch_dir

#: Spark numbers the rows of a task from a multiple of this on.
_TASK_BITS = 33


def trend_view_order() -> list[Column]:
    """Newest hour first, highest ratio first in it, hours without a ratio at its end."""
    return [F.desc("hour_bucket"), F.desc_nulls_last("spike_ratio"), F.col("subreddit"), F.col("keyword")]


def timeline_order() -> list[Column]:
    """Newest hour first, in it those without a ratio, then the highest ratio first."""
    return [F.desc("hour_bucket"), F.desc_nulls_first("spike_ratio"), F.col("subreddit"), F.col("keyword")]


def with_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Adds each row's place from 1 in a total order, however many rows there are.

    Rows are dealt by ranges of the order and sorted in tasks; a task numbers its own, and what comes before it is the sum of the sizes
    of the tasks before. The sorted rows are stored in between, as both steps must see the same tasks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "ordered")
    numbered = df.sort(*order).withColumn("_place", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_task", F.shiftright("_place", _TASK_BITS))
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_task", before.alias("_before"))  # one row per task
    own = F.col("_place") - F.shiftleft("_task", _TASK_BITS)
    return rows.join(F.broadcast(starts), "_task").withColumn(name, F.col("_before") + own + 1).drop("_task", "_place", "_before")
